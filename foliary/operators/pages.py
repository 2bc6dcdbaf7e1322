"""Page and chapter sequences of a body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.core import let

MARK = r"file_page: \d+"


def markers(body: Column) -> Column:
    """The page numbers that a body's markers state, in order."""
    return F.transform(F.regexp_extract_all(body, F.lit(r"file_page: (\d+)"), F.lit(1)), lambda x: x.cast("int"))


def _rewritten(body: Column, numbers: Column) -> Column:
    notes = F.concat(F.transform(numbers, lambda n: F.concat(F.lit("file_page: "), n.cast("string"))), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.split(body, MARK, -1), notes, lambda a, b: F.concat(a, b)), "")


def renumber(body: Column, page_count: Column) -> Column:
    """WIN-04: markers as 1..N if there is one for each page and they are out of order; else the body as it is."""
    wanted = F.sequence(F.lit(1), F.greatest(page_count, F.lit(1)))
    return let(markers(body), lambda m: F.when((F.size(m) == page_count) & (F.size(m) > 0) & (m != wanted), _rewritten(body, wanted)).otherwise(body))


def shift(body: Column, offset: Column) -> Column:
    """WIN-05: the offset added to every page number."""
    return let(markers(body), lambda m: F.when((F.size(m) == 0) | (offset == 0), body).otherwise(_rewritten(body, F.transform(m, lambda n: n + offset))))


def missing(found: Column, page_count: Column) -> Column:
    """WIN-06: pages of 1..N without a marker."""
    return F.when(page_count > 0, F.array_except(F.sequence(F.lit(1), page_count), found)).otherwise(F.expr("cast(array() as array<int>)"))


def impossible(found: Column, page_count: Column) -> Column:
    """WIN-07: why a sequence cannot be true (a page past the last, or one twice), or null; a shortfall is possible."""
    high = F.array_max(found)
    twice = F.array_sort(F.array_distinct(F.filter(found, lambda p: F.size(F.filter(found, lambda q: q == p)) > 1)))
    beyond = F.concat(F.lit("file_page "), high.cast("string"), F.lit(" exceeds the "), page_count.cast("string"), F.lit("-page document"))
    again = F.concat(F.lit("file_page numbers repeat: ["), F.array_join(F.transform(twice, lambda x: x.cast("string")), ", "), F.lit("]"))
    return F.when(high > page_count, beyond).when(F.size(F.array_distinct(found)) < F.size(found), again)


def chunk_plan(page_count: Column, size: int) -> Column:
    """SRC-09: (first, last, offset) of chunks of at most `size` pages."""
    return F.when(
        page_count > 0,
        F.transform(F.sequence(F.lit(1), page_count, F.lit(size)), lambda a: F.struct(a.alias("first"), F.least(a + size - 1, page_count).alias("last"), (a - 1).alias("page_offset"))),
    )


def merge_chunks(chunks: DataFrame, key: str) -> DataFrame:
    """WIN-19: chunks (key, page_offset, body) as one body in page order: page numbers shifted, the first frontmatter alone kept."""
    first = F.row_number().over(W.partitionBy(key).orderBy("page_offset")) == 1
    bare = F.regexp_replace("body", r"(?s)\A---\n.*?\n---\n+", "")
    rows = chunks.select(key, "page_offset", shift(F.when(first, F.col("body")).otherwise(bare), F.col("page_offset")).alias("_b"))
    made = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page_offset", "_b"))).alias("_c"))
    return made.select(key, F.array_join(F.transform("_c", lambda c: F.trim(c["_b"], F.lit("\n"))), "\n\n").alias("body"))


def accepted_numbers(numbers: Column) -> Column:
    """WIN-08: body chapter numbers, null where one is not above all accepted before; a fold, since acceptance feeds itself.

    `numbers` is an array of (toc, body) integers in book order; where `toc` is there, it stands.
    """
    start = F.struct(F.lit(0).alias("high"), F.expr("cast(array() as array<int>)").alias("out"))

    def step(a: Column, x: Column) -> Column:
        n = F.when(x["toc"].isNotNull(), x["toc"]).when(x["body"] > a["high"], x["body"])
        return F.struct(F.greatest(a["high"], F.coalesce(n, F.lit(0))).alias("high"), F.array_append(a["out"], n).alias("out"))

    return F.aggregate(numbers, start, step)["out"]


def boundaries(lines: DataFrame, key: str, most: int = 12) -> DataFrame:
    """WIN-18: the opening of each chapter: a heading and the lines after it, until `most` filled lines (its own included) or the next heading.

    lines: key, line_no (from 1), text. Gives key, chapter, line_no, heading, region.
    """
    head = F.col("text").rlike(r"^#{1,6}\s+\S")
    w = W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    rows = lines.withColumn("chapter", F.sum(F.when(head, 1).otherwise(0)).over(w)).filter("chapter > 0")
    filled = F.when((F.trim("text") != "") & ~head, 1).otherwise(0)
    inside = W.partitionBy(key, "chapter").orderBy("line_no")
    rows = rows.withColumn("_before", F.coalesce(F.sum(filled).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).filter(F.col("_before") < most)
    made = rows.groupBy(key, "chapter").agg(F.min("line_no").alias("line_no"), F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("_l"))
    text = F.transform("_l", lambda x: x["text"])
    return made.select(key, "chapter", "line_no", F.trim(F.element_at(text, 1)).alias("heading"), F.trim(F.array_join(text, "\n"), F.lit(" \n\t")).alias("region"))


def lines_of(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, line_no from 1, text) of every line of a body."""
    return docs.select(key, F.posexplode(F.split(body, "\n", -1)).alias("line_no", "text")).withColumn("line_no", F.col("line_no") + 1)


def irrelevant(lines: DataFrame, key: str) -> DataFrame:
    """WIN-10: `inside` for lines between irrelevant start and end marks, `mark` for the marks; an unclosed region stays open to the end.

    `region` numbers the starts; `closed` tells regions that end from the last one that does not.
    """
    start, end = F.col("text").rlike(r"^\s*<!--\s*irrelevant:\s*start\s*-->\s*$"), F.col("text").rlike(r"^\s*<!--\s*irrelevant:\s*end\s*-->\s*$")
    w = W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    state = F.last(F.when(start, F.lit(True)).when(end, F.lit(False)), ignorenulls=True).over(w)
    rows = lines.withColumn("mark", start | end).withColumn("region", F.sum(F.when(start, 1).otherwise(0)).over(w)).withColumn("inside", F.coalesce(state, F.lit(False)) & ~F.col("mark"))
    return rows.withColumn("closed", F.max(end).over(W.partitionBy(key, "region")) & (F.col("region") > 0))


def materialised_share(lines: DataFrame, key: str) -> DataFrame:
    """AGG-15: share of a body's characters that lie outside irrelevant regions; 1 for an empty body."""
    rows = irrelevant(lines, key)
    n = F.length("text") + 1
    sums = rows.groupBy(key).agg(F.sum(n).alias("all"), F.sum(F.when(~F.col("inside") & ~F.col("mark"), n).otherwise(0)).alias("kept"))
    # line feeds stand between lines, so there is one fewer than lines
    return sums.select(key, F.when(F.col("all") <= 1, F.lit(1.0)).otherwise(F.greatest(F.col("kept") - 1, F.lit(0)) / (F.col("all") - 1)).alias("share"))


def annotation_lines(lines: DataFrame, key: str) -> DataFrame:
    """WIN-11, FLT-18: `inside_note` for lines that a comment block touches; `skippable` for blank lines and one-line comments.

    Irrelevant marks are no blocks. Comments must not nest; they may span lines and share them.
    """
    mark = F.col("text").rlike(r"^\s*<!-- irrelevant: (?:start|end) -->\s*$")
    net = F.when(mark, 0).otherwise(F.regexp_count("text", F.lit("<!--")) - F.regexp_count("text", F.lit("-->")))
    w = W.partitionBy(key).orderBy("line_no")
    rows = lines.withColumn("_open", F.coalesce(F.sum(net).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = ~mark & ((F.col("_open") > 0) | F.contains(F.col("text"), F.lit("<!--")))
    t = F.trim("text")
    return rows.withColumn("inside_note", inside).withColumn("skippable", (t == "") | (t.startswith("<!--") & t.endswith("-->"))).drop("_open")


def layout(lines: DataFrame, key: str) -> DataFrame:
    """WIN-20: (key, line_no, letters) of every filled line outside comment blocks: a fingerprint of a body's layout.

    A block begins at a line that starts with a comment and ends with the line that closes it; comments inside text count
    as text.
    """
    from ..functions.text import squash

    t = F.trim("text")
    opens, closes = t.startswith("<!--"), F.contains(t, F.lit("-->"))
    w = W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    rows = lines.withColumn("_in", F.coalesce(F.last(F.when(closes, F.lit(False)).when(opens, F.lit(True)), ignorenulls=True).over(w), F.lit(False)))
    return rows.filter(~F.col("_in") & ~opens & (t != "")).select(key, "line_no", squash(t).alias("letters"))
