"""Duplicate and contained sections."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.functions.text import WS, normalize_for_dedupe
from korpusmill.session import shared_folder, store

SIDE = ["doc_id", "side"]
KEY = [*SIDE, "section_no"]
NO_PAGE = -1  # every section covers it
#: Pages of a range; characters of the sections that one automaton holds and that one task runs over it, on average.
PAGES, BLOCK_CHARS, RUN_CHARS = 16, 1 << 20, 1 << 25


def first_page(pages: Column) -> Column:
    return F.coalesce(F.array_min(pages), F.lit(10**9)).cast("bigint")


def dedupe_exact(sections: DataFrame) -> DataFrame:
    """Of sections with equal normalized text the longest, the earliest if tied.

    ``position`` is where the text first occurred. A grouped aggregate, so
    copies collapse on the map side.
    """
    value = F.struct(*[c for c in sections.columns if c not in SIDE])
    hashed = sections.withColumn("_hash", F.sha1(normalize_for_dedupe(F.col("content"))))
    best = hashed.groupBy(*SIDE, "_hash").agg(
        F.min_by(value, F.struct(-F.length("content"), F.col("section_no"))).alias("_best"),
        F.min("section_no").alias("position"),
    )
    return best.select(*SIDE, "_best.*", "position")


def dedupe_contained(sections: DataFrame, block_chars: int = BLOCK_CHARS, run_chars: int = RUN_CHARS) -> DataFrame:
    """Drop sections whose text and pages both lie within another section's.

    Takes the result of ``dedupe_exact``. Containment is transitive, so testing
    against all sections gives the same survivors as testing against survivors.

    The sections are needed several times, so they are written to the shared
    folder once, and the keys to drop next to them.
    """
    home = shared_folder(sections.sparkSession, "contained")
    stored = store(sections, f"{home}/sections")
    return stored.join(store(contained(stored, block_chars, run_chars), f"{home}/drop"), KEY, "left_anti")


def contained(sections: DataFrame, block_chars: int = BLOCK_CHARS, run_chars: int = RUN_CHARS) -> DataFrame:
    """Keys of contained sections.

    Whatever contains a section also covers its first page. So a document
    side's sections meet by ranges of pages: those that begin in a range make
    one Aho-Corasick automaton, and all that touch the range run over it once.
    A range with more text is dealt to several automata, and those that run
    over each to several tasks; rows stream past, so a task holds one automaton
    alone. Sections without a list of pages neither contain nor are contained.
    Those with an empty one lie within any: only on sides that have such do all
    sections meet once more.
    """
    spark = sections.sparkSession
    # Loads are sums of plain lengths, so that step normalizes no text.
    base = sections.where(F.col("page_numbers").isNotNull() & F.col("content").rlike(rf"[^{WS}]")).select(
        *KEY, "position", "page_numbers",
        F.length("content").alias("size"),
        normalize_for_dedupe(F.col("content")).alias("norm"),
    )
    in_range = lambda page: F.floor(page / PAGES).cast("bigint")
    ranged = base.withColumn("own", in_range(F.coalesce(F.array_min("page_numbers"), F.lit(NO_PAGE))))
    nowhere = in_range(F.lit(NO_PAGE))
    paged = ranged.withColumn("range", F.explode(F.array_distinct(F.transform("page_numbers", in_range)))).where(F.col("range") != nowhere)
    pageless = ranged.where(F.col("own") == nowhere).select(*SIDE).distinct()
    pageless = store(pageless, shared_folder(spark, "pageless"))
    spread = paged.unionByName(ranged.join(pageless, SIDE, "left_semi").withColumn("range", nowhere))
    here = F.col("own") == F.col("range")
    loads = spread.groupBy(*SIDE, "range").agg(
        F.sum(F.when(here, F.col("size")).otherwise(0)).alias("held"), F.sum("size").alias("run")
    )
    large = loads.where((F.col("held") > block_chars) | (F.col("run") > run_chars)).select(
        *SIDE, "range", F.ceil(F.greatest("held", F.lit(1)) / block_chars).alias("blocks"), F.ceil(F.col("run") / run_chars).alias("runs")
    )
    # Stored, so that Spark knows how few they are and does not shuffle the texts to find them.
    dealt = spread.join(store(large, shared_folder(spark, "large-ranges")), [*SIDE, "range"], "left")

    def place(block: Column, run: Column, part: Column) -> Column:
        return F.struct(block.cast("bigint").alias("block"), run.cast("bigint").alias("run"), part.alias("part"))

    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    zero = F.lit(0)
    own_block, own_run = F.pmod(F.xxhash64("section_no"), F.col("blocks")), F.pmod(F.xxhash64("section_no", F.lit("run")), F.col("runs"))
    held = F.when(here, F.transform(upto("runs"), lambda r: place(own_block, r, F.lit(_HELD)))).otherwise(F.array().cast("array<struct<block:bigint,run:bigint,part:int>>"))
    running = F.transform(upto("blocks"), lambda b: place(b, own_run, F.lit(_RUNS)))
    places = F.when(F.col("blocks").isNull(), F.array(place(zero, zero, F.when(here, F.lit(_BOTH)).otherwise(F.lit(_RUNS))))).otherwise(F.concat(held, running))
    group = [*SIDE, "range", "block", "run"]
    rows = dealt.withColumn("at", F.explode(places)).select(
        *SIDE, "range", "at.block", "at.run", "at.part", "section_no", "size", "position", "page_numbers", "norm"
    )
    rows = rows.repartition(*group).sortWithinPartitions(*group, "part")
    kinds = dict(rows.dtypes)
    found = rows.mapInArrow(_contained_in_stream, ", ".join(f"{c} {kinds[c]}" for c in KEY))
    return found.distinct()


_BOTH, _HELD, _RUNS = 0, 1, 2


class _Block:
    """The sections of one automaton, and which of them were found inside others."""

    def __init__(self):
        self.sections: list[tuple] = []  # key, (size, -position), pages
        self.by_text: dict[str, list[int]] = {}
        self.waiting: list[tuple] = []
        self.automaton = None
        self.found: set[int] = set()

    def add(self, key: tuple, place: tuple, pages: frozenset, text: str) -> None:
        self.by_text.setdefault(text, []).append(len(self.sections))
        self.sections.append((key, place, pages))

    def run(self, place: tuple, pages: frozenset, text: str) -> None:
        if self.automaton is None:
            from ahocorasick import Automaton

            self.automaton = Automaton()
            for word, numbers in self.by_text.items():
                self.automaton.add_word(word, tuple(numbers))
            self.automaton.make_automaton()
        if not self.by_text:
            return
        seen = set()
        for _, numbers in self.automaton.iter(text):
            if numbers in seen:
                continue
            seen.add(numbers)
            for i in numbers:
                if i not in self.found and place > self.sections[i][1] and self.sections[i][2] <= pages:
                    self.found.add(i)

    def close(self) -> list[tuple]:
        if len(self.sections) > 1 or self.automaton is not None:
            for waiting in self.waiting:
                self.run(*waiting)
        return [self.sections[i][0] for i in self.found]


def _contained_in_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, block = None, _Block()
    schema = None

    def keys(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], names=KEY)

    for batch in batches:
        narrow = batch.select(["doc_id", "side", "range", "block", "run", "part", "section_no", "size", "position", "page_numbers"])
        schema = [batch.schema.field(c) for c in KEY]
        texts = batch.column(batch.schema.get_field_index("norm"))
        for row, text in zip(zip(*(c.to_pylist() for c in narrow.columns)), texts):
            *at, part, section, size, position, pages = row
            if at != group:
                if out := block.close():
                    yield keys(out)
                group, block = at, _Block()
            place, pages, text = (size, -position), frozenset(pages), text.as_py()
            if part != _RUNS:
                block.add((at[0], at[1], section), place, pages, text)
            if part == _BOTH:
                block.waiting.append((place, pages, text))
            if part == _RUNS:
                for waiting in block.waiting:
                    block.run(*waiting)
                block.waiting = []
                block.run(place, pages, text)
    if out := block.close():
        yield keys(out)


def section_order() -> list[Column]:
    """First page, then key as text, then name; ties keep longer and earlier texts first."""
    return [
        first_page(F.col("page_numbers")),
        F.coalesce("section_key", F.lit("")),
        F.col("name"),
        -F.length("content"),
        F.col("position"),
    ]


def dedupe_sections(sections: DataFrame) -> DataFrame:
    """Exact duplicates first, then contained sections."""
    return dedupe_contained(dedupe_exact(sections))
