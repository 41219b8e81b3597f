"""Byte-pair piece encoding by a merge-type prefix table, and decoding.

For every prefix of a word the table stores the last token of that prefix's encoding. That token is unique: it is the token
that ends there (found by an automaton over all pieces), continues a prefix whose own last token is compatible with it, and
compatible means that the two, put side by side, are not merged across their border before each is whole. The ids are then
read off backwards, from the last prefix to the first.

Null texts count as empty and have no ids; a text of any length is encoded word by word, and no word is cut; repeated rows
give repeated results; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from hearthline.llm.common import pieces

MARK = "▁"
#: Distinct words whose ids a task keeps; beyond that it starts anew.
KEPT_WORDS = 250_000
#: The longest word that is kept.
KEPT_CHARS = 64


class PieceCodec:
    """Encoder and decoder of a byte-pair model file, equal to the library's own, without begin or end ids."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        special = {i for i in range(size) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        runs = {len(p) for p in self.ids if not p.strip(MARK)}
        others = [p for p in self.ids if p.strip(MARK)]
        # merges then never cross from one word into the next, and those among marks alone come last
        assert not any(MARK in p[1:] for p in others), "a piece may hold one mark, at its beginning"
        assert len({self.score[p] for p in others}) == len(others), "scores must differ"
        assert len({self.score[MARK * n] for n in runs if n > 1}) < 2 and all(self.score[MARK * n] < self.score[p] for n in runs if n > 1 for p in others if len(p) > 1)
        self.longest = max(runs)
        self.runs = [self._run(n) for n in range(self.longest + 1)]
        # a line end that no piece holds parts words, and so does a sign that no piece holds after anything but signs and marks
        line = "\n" if not any("\n" in p for p in self.ids) else ""
        signs, letters = set(string.punctuation), set()
        pairs = {(x, y) for p in self.ids for x, y in zip(p, p[1:]) if x != MARK}
        while odd := next(((x, y) for x, y in pairs if y in signs and x not in signs), None):
            if odd[0].isalpha() or odd[0] in letters:
                signs.discard(odd[1])
                letters.add(odd[1])
            else:
                signs.add(odd[0])
        sign, other = f"[{re.escape(''.join(sorted(signs)))}]", f"[^{MARK}{line}{re.escape(''.join(sorted(signs)))}]"
        self.words = re.compile(f"{MARK}+{sign}*{other}*|{sign}+{other}*|{other}+" + "|\n+" * bool(line))
        #: The two pieces whose merge makes a piece, for pieces that merges reach.
        self.whole = {p: pair for p in self.ids if len(p) > 1 and (pair := self._whole(p))}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) == 1 or piece in self.whole:
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.fits = lru_cache(1 << 18)(self._fits)
        self.kept: dict[str, str] = {}

    def _run(self, n: int) -> list[int]:
        """The ids of n marks: their merges have one score, so the leftmost goes first."""
        parts = [MARK] * n
        while (k := next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in self.ids), -1)) >= 0:
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ids[p] for p in parts]

    def _whole(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes a piece, or None where merges never reach it."""
        parts = list(piece)
        while len(parts) > 2:
            best = max(range(len(parts) - 1), key=lambda k: (self.score.get(parts[k] + parts[k + 1], float("-inf")), -k))
            if parts[best] + parts[best + 1] not in self.score:
                return None
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _fits(self, left: str, right: str) -> bool:
        """Whether the text of two pieces side by side is encoded as just these two.

        Both are taken apart at the border, the later merge first: if the parts that then touch would have been merged with
        each other before that merge (or were the same merge further to the left), the pair cannot stand.
        """
        score, limit, tie = self.score, float("-inf"), False
        while True:
            joined = score.get(left + right)
            if joined is not None and (joined > limit or tie and joined == limit):
                return False
            before, after = self.whole.get(left), self.whole.get(right)
            if not before and not after:
                return True
            # undo the merge that came last, that is the one with the lower score
            if before and (not after or score[left] < score[right]):
                limit, tie, left = score[left], False, before[1]
            else:
                limit, tie, right = score[right], True, after[0]

    def encode_word(self, word: str) -> list[int]:
        """The ids of a word: of its last mark with the characters after it, and of the marks before."""
        marks = len(word) - len(word.lstrip(MARK))
        out = self.encode_plain(word[marks - 1 :] if marks else word) if marks < len(word) else []
        if marks and out and out[0] != self.ids[MARK]:
            marks -= 1
        elif out and marks:
            out = out[1:]
        return self.runs[self.longest] * (marks // self.longest) + self.runs[marks % self.longest] + out

    def encode_plain(self, word: str) -> list[int]:
        """The ids of a word with one mark at most, with unknown characters as bytes."""
        n = len(word)
        last: list[str | None] = [None] * n
        for end, piece in self.automaton.iter(word):
            if last[end] is None:
                before = end - len(piece)
                # where no piece ends there is a character that only bytes can write: it fits with anything
                if before < 0 or last[before] is None or self.fits(last[before], piece):
                    last[end] = piece
        out: list[int] = []
        i = n - 1
        while i >= 0:
            piece = last[i] or word[i]
            known = self.ids.get(piece)
            out.extend([known] if known is not None else [self.byte_ids[b] for b in reversed(piece.encode())])
            i -= len(piece)
        return out[::-1]

    def marked(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def parts(self, text: str) -> list[str]:
        """The ids of each word of a text, in decimals with commas."""
        kept, out = self.kept, []
        for word in self.words.findall(self.marked(text)):
            found = kept.get(word)
            if found is None:
                found = ",".join(map(str, self.encode_word(word)))
                if len(word) <= KEPT_CHARS:
                    if len(kept) >= KEPT_WORDS:
                        kept.clear()
                    kept[word] = found
            out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        return numbers(",".join(self.parts(text)))

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


def numbers(written: str) -> list[int]:
    return list(map(int, written.split(","))) if written else []


@lru_cache(2)
def codec_of(path: str) -> PieceCodec:
    """One codec for all tasks of a Python worker."""
    return PieceCodec(path)


def encode_decode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; with ``keep_ids`` also the ids and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch, texts in pieces(batches, "text", 1 << 20):
            rows = []
            for text in texts.to_pylist():
                written = ",".join(codec.parts(text))
                ids = numbers(written)
                decoded = codec.decode(ids)
                row = (len(ids), sha(written), sha(decoded))
                rows.append((*row, ids, decoded) if keep_ids else row)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], out.names)

    ddl = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    out = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(ddl).fields])
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, out)
