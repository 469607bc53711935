"""Page selections: all, a list in its own order, or a slice; and the specs that name them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Selection:
    """kind is all, list or slice; a slice's parts may be None."""

    kind: str = "all"
    pages: tuple[int, ...] = ()
    start: int | None = None
    stop: int | None = None
    step: int | None = None


def parse(spec: str) -> Selection:
    """`all` in any case, `0,2,5`, or `start:stop:step` with parts left out. ValueError for anything else."""
    spec = spec.strip()
    if spec.lower() == "all":
        return Selection()
    if ":" in spec:
        parts = [int(p) if p.strip() else None for p in spec.split(":")]
        if len(parts) > 3:
            raise ValueError(f"a slice has at most three parts: {spec!r}")
        return Selection("slice", (), *parts)
    return Selection("list", tuple(int(p) for p in spec.split(",")))


def parsed(spec: Column) -> Column:
    """parse() as a column: kind (error for a bad spec), pages (comma-joined), start, stop, step."""
    text = F.trim(spec)
    parts = F.split(text, ":", -1)
    whole = r"^\s*[+-]?\d{1,9}\s*$"
    part = lambda i: F.get(parts, F.lit(i))
    cut = lambda i: F.when(F.trim(part(i)) != "", F.trim(part(i)).cast("int"))
    good_slice = (F.size(parts) <= 3) & F.forall(parts, lambda p: (F.trim(p) == "") | p.rlike(whole))
    pages = F.split(text, ",", -1)
    good_list = F.forall(pages, lambda p: p.rlike(whole))
    kind = F.when(F.lower(text) == "all", "all").when(F.contains(text, F.lit(":")), F.when(good_slice, "slice").otherwise("error")).when(good_list, "list").otherwise("error")
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "list", F.array_join(F.transform(pages, lambda p: F.trim(p).cast("int").cast("string")), ",")).alias("pages"),
        *[F.when(kind == "slice", cut(i)).alias(c) for i, c in enumerate(("start", "stop", "step"))],
    )


def _bounds(s: Selection, n: Column) -> tuple[Column, Column, int]:
    step = 1 if s.step is None else s.step
    if step == 0:
        raise ValueError("a slice's step can't be 0")
    low, high = (F.lit(0), n) if step > 0 else (F.lit(-1), n - 1)

    def place(i: int | None, absent: Column) -> Column:
        if i is None:
            return absent
        return F.least(F.greatest(n + i, low) if i < 0 else F.lit(i), high)

    return (place(s.start, low if step > 0 else high), place(s.stop, high if step > 0 else low), step)


def select_pages(pages: DataFrame, selection: Selection, doc: str = "doc", index: str = "page_idx") -> DataFrame:
    """The selected pages with pos, their place in the selection from 0.

    A list keeps its order and repeats, except that a selection of exactly all pages leaves the document as it is.
    A slice follows Python's rules. A list with a page that a document lacks raises when the plan runs.
    """
    if selection.kind == "all":
        return pages.withColumn("pos", F.col(index))
    counts = pages.groupBy(doc).agg(F.count("*").alias("_n"))
    if selection.kind == "slice":
        n, i = F.col("_n"), F.col(index)
        start, stop, step = _bounds(selection, n)
        if step > 0:
            keep, pos = (i >= start) & (i < stop) & ((i - start) % step == 0), F.floor((i - start) / step)
        else:
            keep, pos = (i <= start) & (i > stop) & ((start - i) % -step == 0), F.floor((start - i) / -step)
        # A slice covers a document if it takes all pages; then their own order stays.
        whole = (F.greatest(stop - start, F.lit(0)) if step > 0 else F.greatest(start - stop, F.lit(0))) >= n
        whole = whole & F.lit(abs(step) == 1) | (n == 1)
        out = pages.join(counts, doc).where(keep).withColumn("pos", F.when(whole, i).otherwise(pos).cast("long"))
        return out.drop("_n")
    wanted = F.array(*[F.lit(p).cast("long") for p in selection.pages]) if selection.pages else F.array().cast("array<long>")
    covers = F.array_sort(F.array_distinct(wanted)) == F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)
    lacking = F.exists(wanted, lambda p: (p < 0) | (p >= F.col("_n")))
    chosen = F.when(lacking, F.raise_error(F.concat(F.lit("a selected page is missing in "), F.col(doc).cast("string"))).cast("array<long>"))
    chosen = chosen.when(covers, F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).otherwise(wanted)
    places = counts.select(F.col(doc).alias("_doc"), F.posexplode(chosen).alias("pos", "_page"))
    return pages.join(places, (F.col(doc) == F.col("_doc")) & (F.col(index) == F.col("_page"))).drop("_doc", "_page").withColumn("pos", F.col("pos").cast("long"))


def page_numbers(rows: DataFrame, doc: str, order: str) -> DataFrame:
    """page_idx from 0 by order within doc."""
    return rows.withColumn("page_idx", F.row_number().over(Window.partitionBy(doc).orderBy(order)).cast("long") - 1)
