"""Text matching as functions of SQL (AGG-14, SCH-01 .. SCH-03, FLT-10).

The functions are SQL expressions themselves, which Catalyst puts in place of their calls, so a
statement that calls them stays in the JVM and its constant queries are analysed once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from rillflow.functions.text import HAN, WORD

# Name, parameters, type and expression; later ones call earlier ones.
FUNCTIONS = (
    ("analysed", "words STRING", "ARRAY<STRING>",
     f"regexp_extract_all(lower(regexp_replace(words, r'{HAN}', ' $1 ')), r'{WORD}', 0)"),
    ("match_score", "field STRING, query STRING", "INT",
     "size(array_intersect(analysed(field), analysed(query)))"),
    ("match", "field STRING, query STRING", "BOOLEAN",
     "arrays_overlap(analysed(field), analysed(query))"),
    ("match_all", "field STRING, query STRING", "BOOLEAN",
     "size(analysed(query)) > 0 AND size(array_except(analysed(query), analysed(field))) = 0"),
    ("match_phrase", "field STRING, query STRING", "BOOLEAN",
     "contains(concat(' ', array_join(analysed(field), ' '), ' '),"
     " concat(' ', array_join(analysed(query), ' '), ' '))"),
    ("match_token", "field STRING, token STRING", "BOOLEAN",
     "array_contains(analysed(field), token)"),
)


def register_text_functions(spark: SparkSession) -> None:
    """Make the functions known to the session; doing so again changes nothing.

    ``match`` asks for any token of the query, ``match_all`` for each, ``match_phrase`` for all of
    them one after the other, ``match_token`` for one as it is; ``match_score`` counts the distinct
    tokens hit. A null text or query gives null, which no filter passes.
    """
    for name, parameters, kind, expression in FUNCTIONS:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {expression}"
        )
