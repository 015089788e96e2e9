"""Analytics over sequencing-alignment tables, written for Spark's DataFrame engine."""
