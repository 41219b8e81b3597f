"""Prompt assembly for a table of requests, and batch inference with row-level errors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

EXAMPLES_MARK = "[Single-parameter Examples"
OUTPUT_MARK = "[Output instruction]"
BLANKS = " \t\n\r\x0b\x0c　"

PARAMETERS = ["tone", "length", "formality", "emoji_density", "structure", "cta_strength"]

# Header, precedence line, labels and explanations of the parameter block.
BLOCK_HEADER = "[Hyperparameter Definitions — この生成の指定値]"
BLOCK_PRECEDENCE = "- このブロックは [User request] 内の文体・長さ・構成・絵文字・CTA の記述より優先する"
BLOCK_LABELS = {
    "tone": "Tone",
    "length": "Length",
    "formality": "Formality",
    "emoji_density": "Emoji density",
    "structure": "Structure",
    "cta_strength": "Call-to-action strength",
}
BLOCK_HELP = {
    "length": "short: 〜100字（1〜2文） / medium: 101〜300字（2〜5文） / long: 301字〜（補足・背景あり）",
    "emoji_density": "なし=0個 / 少なめ=1〜2個 / 普通=3〜5個 / 多め=6個以上",
}
CONTEXT_HEADER = "[Context facts]"
REQUEST_HEADER = "[User request (natural language)]"


@dataclass(frozen=True)
class Template:
    """The constant text around a request: what precedes the parameters, the examples, the closing part."""

    head: str
    examples: str
    closing: str

    @classmethod
    def parse(cls, text: str) -> Template:
        head, mark, rest = text.partition(EXAMPLES_MARK)
        examples, end, closing = rest.partition(OUTPUT_MARK)
        if not mark or not end:
            raise ValueError(f"template needs the markers {EXAMPLES_MARK!r} and {OUTPUT_MARK!r}")
        return cls(head.rstrip(), (mark + examples).rstrip(), end + closing.strip())


def parameter_block() -> Column:
    lines = [F.lit(BLOCK_HEADER), F.lit(BLOCK_PRECEDENCE)]
    for name in PARAMETERS:
        help_text = f" ({BLOCK_HELP[name]})" if name in BLOCK_HELP else ""
        lines.append(F.concat(F.lit(f"- {BLOCK_LABELS[name]}: "), F.col(name), F.lit(help_text)))
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))


def _stripped(c: str) -> Column:
    return F.btrim(F.col(c), F.lit(BLANKS))


def build_prompts(requests: DataFrame, template: str | Template, out: str = "full_prompt") -> DataFrame:
    """One prompt per request: head, parameters, examples, optional facts, request, closing instruction."""
    t = template if isinstance(template, Template) else Template.parse(template)
    parts = [F.lit(t.head), parameter_block(), F.lit(t.examples)]
    if "context_facts" in requests.columns:
        facts = _stripped("context_facts")
        parts.append(F.when(facts != "", F.concat(F.lit(f"{CONTEXT_HEADER}\n"), facts)))
    parts += [F.concat(F.lit(f"{REQUEST_HEADER}\n"), _stripped("user_request")), F.lit(t.closing)]
    return requests.withColumn(out, F.concat_ws("\n\n", *parts))


def batch_infer(df: DataFrame, fn: Callable[[list[str]], list[str]], col: str = "full_prompt", out: str = "response", error: str = "error") -> DataFrame:
    """Call ``fn`` on batches of texts inside the tasks. A batch that fails is retried row by row, and a row
    that still fails gets its message in ``error`` instead of stopping the job."""

    def one(text: str) -> tuple[str | None, str | None]:
        try:
            return fn([text])[0], None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[col].tolist()
            try:
                answers = [(a, None) for a in fn(texts)]
                if len(answers) != len(texts):
                    raise ValueError("answers and prompts differ in number")
            except Exception:
                answers = [one(t) for t in texts]
            yield pdf.assign(**{out: [a for a, _ in answers], error: [e for _, e in answers]})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{schema}, `{out}` string, `{error}` string")


def parse_response(df: DataFrame, col: str = "response") -> DataFrame:
    """``text`` and ``error_message`` of a ``{result, errorMessage}`` answer; other answers are taken as text."""
    parsed = F.from_json(F.col(col), "result string, errorMessage string", {"mode": "PERMISSIVE"})
    failed = F.nullif(parsed["errorMessage"], F.lit(""))
    text = F.when(failed.isNull(), F.coalesce(parsed["result"], F.col(col)))
    return df.withColumns({"text": text, "error_message": failed})
