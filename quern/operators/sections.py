"""Documents to chunks: Markdown headers, underlined headings, listings of symbols, notebook cells.

Line-based parsers explode a text into numbered lines and use windows within one
document; texts are never gathered across documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.keys import strip
from quern.functions.text import slug

_UNDERLINE = r"^[-=]{3,}$"


def markdown_sections(docs: DataFrame, key: str, text: str, least: int = 100) -> DataFrame:
    """Sections that begin at ``##`` or ``###`` headers: ``key, section, title, content`` for at least ``least`` characters."""
    parts = docs.select(key, F.posexplode(F.split(text, r"\n(?=###?\s)")).alias("section", "raw"))
    content = strip(F.col("raw"))
    title = F.left(F.split(content, "\n")[0], F.lit(120))
    return parts.where(F.length(content) >= least).select(key, "section", title.alias("title"), content.alias("content"))


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line_no, line``."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def _headed(lines: DataFrame, key: str) -> DataFrame:
    """Lines with ``heading`` (of the section a line is in, null before the first), ``head_no`` and ``is_head``, ``is_rule``."""
    order = Window.partitionBy(key).orderBy("line_no")
    rule = F.col("line").rlike(_UNDERLINE)
    is_head = F.coalesce(F.lead("line").over(order).rlike(_UNDERLINE), F.lit(False)) & (strip(F.col("line")) != "") & ~rule
    marked = lines.withColumn("is_head", is_head).withColumn("is_rule", F.coalesce(F.lag("is_head").over(order), F.lit(False)))
    head_no = F.last(F.when(F.col("is_head"), F.col("line_no")), ignorenulls=True).over(order)
    heading = F.last(F.when(F.col("is_head"), strip(F.col("line"))), ignorenulls=True).over(order)
    return marked.withColumns({"head_no": head_no, "heading": heading})


def underlined_sections(docs: DataFrame, key: str, text: str, least: int = 80) -> DataFrame:
    """Sections under underlined headings: ``key, section_id, title, content`` for bodies of at least ``least`` characters."""
    body = _headed(lines_of(docs, key, text), key).where("head_no is not null and not is_head and not is_rule")
    joined = body.groupBy(key, "head_no", "heading").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))  # lines of one section
    content = strip(F.array_join(F.transform("l", lambda x: x.line), "\n"))
    out = joined.select(key, F.concat(F.lit("sem_"), slug(F.col("heading"))).alias("section_id"), F.col("heading").alias("title"), content.alias("content"))
    return out.where(F.length("content") >= least)


def listed_symbols(docs: DataFrame, key: str, text: str, marker: str = ".. autosummary::") -> DataFrame:
    """Symbols of listing blocks with the heading above them, the first of each name in a document.

    A block is the indented or blank lines after the marker; option lines begin with a colon.
    """
    lines = _headed(lines_of(docs, key, text), key)
    order = Window.partitionBy(key).orderBy("line_no")
    opens = strip(F.col("line")) == marker
    breaks = ~opens & (strip(F.col("line")) != "") & ~F.col("line").startswith(" ")
    state = F.last(F.when(opens, F.lit(True)).when(breaks, F.lit(False)), ignorenulls=True).over(order)
    name = strip(F.col("line"))
    hits = lines.withColumn("inside", state).where(F.col("inside") & ~opens & name.rlike("^[a-z][a-z0-9_]*$"))
    first = hits.groupBy(key, name.alias("symbol")).agg(F.min(F.struct("line_no", "heading")).alias("f"))
    return first.select(key, "symbol", F.col("f.heading").alias("category"), F.concat(F.lit("api_"), F.col("symbol")).alias("section_id"))


def tutorial_cells(docs: DataFrame, key: str, text: str, least: int = 80) -> DataFrame:
    """Comment prose of ``# %%`` cells: ``key, cell, title, content`` for at least ``least`` characters.

    Prose is the ``# `` lines before the first code line of a cell; the doc string before the first cell is cell 0.
    """
    cells = docs.select(key, F.posexplode(F.split(text, r"(?m)^# %%\s*$")).alias("cell", "raw"))
    lines = F.split("raw", "\n")
    is_code = lambda x: (strip(x) != "") & ~x.startswith("#")
    first_code = F.coalesce(F.array_min(F.filter(F.transform(lines, lambda x, i: F.when(is_code(x), i)), lambda i: i.isNotNull())), F.size(lines))
    prose = F.transform(F.filter(F.slice(lines, F.lit(1), first_code), lambda x: x.startswith("# ")), lambda x: strip(F.substr(x, F.lit(3))))
    intro = F.regexp_extract(F.col("raw"), r'(?s)^"""(.*?)"""', 1)
    content = strip(F.when(F.col("cell") == 0, intro).otherwise(F.array_join(prose, "\n")))
    out = cells.select(key, "cell", content.alias("content")).where(F.length("content") >= least)
    title = F.regexp_replace(F.split("content", "\n")[0], "^[=\\- ]+|[=\\- ]+$", "")
    return out.select(key, "cell", title.alias("title"), "content")


def without_directives(c: Column) -> Column:
    """Reference-page text without directive lines, their option lines and blank runs."""
    c = F.regexp_replace(c, r"(?m)^[ \t]*\.\. [^\n]*::[ \t]*\n(?:[ \t]*(?::[^\n]*)?\n)*", "")
    c = F.regexp_replace(c, r"(?m)^[ \t]*\.\.[^\n]*\n?", "")
    return F.regexp_replace(strip(c), r"\n{3,}", "\n\n")
