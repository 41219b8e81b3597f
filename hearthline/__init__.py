"""Community and sales analytics as plain DataFrame-to-DataFrame operators on PySpark."""
