"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

SCHEMA = "doc_id bigint, text string, lang string, rank int, score double, row long, spans string, term string, entity string, tags map<string,string>"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 0.5, 7, "x", "y", "z", {"a": "b"}) for i, t in rows], SCHEMA)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
