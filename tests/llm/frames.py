"""Small tables with the awkward cases every operator has to define."""

from __future__ import annotations

TEXT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table from (doc_id, text) pairs."""
    data = [(key, text, "en", "src", len(text) if text is not None else None) for key, text in rows]
    return spark.createDataFrame(data, TEXT)


def awkward(base):
    """``base`` rows plus null, empty, blank, repeated and null-id rows."""
    return [*base, (9001, None), (9002, ""), (9003, " \n\t"), (9004, "x"), (None, base[0][1]), base[0], base[0]]
