"""Names in SQL: a table function over pages, and the text functions.

``register(spark)`` makes them known to a session. The text functions are SQL functions with bodies of built-in
functions, so a query that calls one is planned as if they were written out: nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from gleanworks.functions import html as H
from gleanworks.functions import text as X


class ScheduleTable:
    """``schedule_table(html, 'date,opponent,...')``: a row for each game of a page.

    Columns are game_index, the cells by the names given, in their order (cells that a row lacks are empty), and
    opp_href. Pages without a schedule give no rows.
    """

    def __init__(self) -> None:
        self.cells: int | None = None

    @staticmethod
    def analyze(html: AnalyzeArgument, names: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(names.value, str):
            raise ValueError("the names of the cells must be a constant text")
        cells = [n.strip() for n in names.value.split(",") if n.strip()]
        schema = T.StructType().add("game_index", T.IntegerType())
        for n in cells:
            schema = schema.add(n, T.StringType())
        return AnalyzeResult(schema.add("opp_href", T.StringType()))

    def eval(self, html: str, names: str):
        if self.cells is None:
            self.cells = sum(bool(n.strip()) for n in names.split(","))
        for row in H.schedule_rows(html)["rows"]:
            cells = row["cells"][: self.cells]
            yield row["game_index"], *cells, *[""] * (self.cells - len(cells)), row["opp_href"]


def _quoted(pattern: str) -> str:
    """A pattern as a raw SQL text."""
    return 'r"' + pattern.replace('"', "[\\x22]") + '"'


def _bodies() -> dict[str, str]:
    """Name to body over the argument ``s``."""
    trimmed = lambda x: f"regexp_replace({x}, {_quoted(X.BLANK_ENDS)}, '')"
    low = "regexp_replace(lower(coalesce(s, '')), '[^a-z0-9 ]', ' ')"
    plain = f"CASE WHEN startswith(trim({low}), 'the ') THEN substring(trim({low}), 5) ELSE {low} END"
    cell = f"lower({trimmed('coalesce(s, \'\')')})"
    one_line = trimmed(f"regexp_replace(coalesce(s, ''), {_quoted('(?U)\\s+')}, ' ')")
    opened = trimmed(f"regexp_replace({one_line}, {_quoted(X.OPENING)}, '')")
    parts = f"filter(transform(split({opened}, {_quoted(X.SEPARATOR)}, -1), x -> {trimmed('x')}), x -> x <> '')"
    good = f"filter({parts}, x -> NOT ({trimmed('lower(x)')} RLIKE {_quoted(X.DOMAIN)} OR lower(x) RLIKE {_quoted(X.JUNK_PATTERN)}))"
    longest = lambda a: f"aggregate({a}, '', (acc, x) -> CASE WHEN length(x) > length(acc) THEN x ELSE acc END)"
    return {
        "normalize_name": f"trim(regexp_replace(regexp_replace({plain}, {_quoted(X.GENERIC_WORDS)}, ' '), {_quoted('\\s+')}, ' '))",
        "is_junk": f"{cell} <> '' AND ({cell} RLIKE {_quoted(X.DOMAIN)} OR {cell} RLIKE {_quoted(X.JUNK_PATTERN)})",
        "clean_title": f"CASE WHEN size({good}) > 0 THEN {longest(good)} ELSE {longest(parts)} END",
        "result_of": f"regexp_extract(coalesce(s, ''), {_quoted(X.RESULT)}, 1)",
        "score_of": f"replace(regexp_extract(coalesce(s, ''), {_quoted(X.SCORE)}, 1), ' ', '')",
    }


def register(spark: SparkSession) -> None:
    """Make ``schedule_table`` and the text functions known to the session."""
    spark.udtf.register("schedule_table", udtf(ScheduleTable))
    for name, body in _bodies().items():
        kind = "BOOLEAN" if name == "is_junk" else "STRING"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS {kind} RETURN {body}")
