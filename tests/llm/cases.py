"""Rows that every operator must bear: nulls in any column, empty and long texts, ties, copies,
and other columns whose names clash with those the operators add or use inside."""

CLASH = ("fingerprint", "component_id", "ids", "spans", "verdict", "kept", "owner", "group", "key")
SCHEMA = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASH)

PROSE = ("The harbour master kept a ledger of every ship that came in with the tide, and noted the "
         "cargo, the captain and the weather, so that in winter there was something to read. ")

TEXTS = [
    (None, None), (None, "a text whose id is null"), (None, "a text whose id is null"),
    (1, None), (2, ""), (3, " \n\t "), (4, PROSE), (5, PROSE), (5, PROSE), (6, PROSE.upper()),
    (7, PROSE * 40), (8, "word " * 3000), (9, "x" * 5000), (10, "café naïve ½ 語 \x1c <|endoftext|> \U0001F600"),
    (11, "line\nline\nline\n" * 5),
]


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, *[None if k % 2 else "x"] * len(CLASH)) for k, (i, t) in enumerate(rows)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))
