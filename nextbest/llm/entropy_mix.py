"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets: the sources share all words by weight; a target stops at
``max_copies`` times its source's size and the excess is shared again.

Entropy balancing asks for the word masses closest to the given ones (in
relative entropy, each word one unit) whose total in each source is its target.
The convex dual has one multiplier l a source; its gradient is
``size * exp(l) - target`` and a document's rate is exponentially tilted,
``exp(l)``.  A source's size is all that the gradient needs from its documents,
so documents are summed once and the Newton steps run over the distributed
table of sources until every constraint holds to 1e-12.

Rounding a rate into whole copies: every document gets ``floor(rate)``; the
remaining words go, one copy each, to the documents with the smallest hashes of
id and text (identical rows are numbered, and the number hashed too), up to a
threshold hash found from bucket sums.  What is missing
then (less than one document) is filled by the largest documents that still
fit, one for each source and round.  If ``FILL_ROUNDS`` of them don't do, as
when the document at the threshold is a very long one, it is skipped: the same
search for a threshold runs over the documents behind it that are no larger than
the gap, then the largest are filled in again, until nothing left fits.  At last
comes one document that overshoots if that is nearer.  A source's decision is
thus a threshold, a short list and a few spans of hashes with a largest size,
applied to documents of any width by one join with the sources.

Hot sources: sums are pre-aggregated, only the one bucket of 4,096 that holds a
source's threshold is ever sorted, and the table of sources is broadcast if its
measured bytes allow (else the join is salted).

Edge cases: null and empty texts have size 0 and take 0 words; a null source is
a source of its own, sorted last; identical rows are numbered in no particular
order, as they can't be told apart, and taken one by one; a source without words has target 0; an empty table gives an empty
result; extra columns pass through ``apply_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nextbest.llm.common import checkpointed, words
from nextbest.operators.joins import join_small, measured_bytes
from nextbest.operators.ranking import positions

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
FILL_ROUNDS = 16
#: Counts are whole words; this absorbs rounding when one is compared with a share.
TOL = 1e-3
_BUCKET_DIGITS = 3

_KEY, _HASH = "__source_key", "__hash"


def with_mix_keys(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
                  text: str = "text") -> DataFrame:
    """Adds size, the source's key (distinct for null) and the document's hash."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))
    seen = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("\n"),
                    F.coalesce(F.col(text), F.lit("")))
    return (docs.withColumn("size", F.size(words(F.col(text))).cast("long"))
            .withColumn(_KEY, key).withColumn(_HASH, F.md5(seen.cast("binary"))))


def repeated_rows(keyed: DataFrame) -> DataFrame | None:
    """(key, hash) of the rows that the table holds more than once; None: there are none."""
    found = checkpointed(keyed.groupBy(_KEY, _HASH).agg(F.count(F.lit(1)).alias("n")).where(
        "n > 1").select(_KEY, _HASH, F.lit(True).alias("__again")))
    return None if found.isEmpty() else found


def numbered(keyed: DataFrame, repeats: DataFrame | None) -> DataFrame:
    """The rows, identical ones with hashes of their own from the second on.

    Only repeated rows are moved.  They are numbered by range partitions that
    split a group of copies, so a row repeated a billion times is no one task's.
    """
    if repeats is None:
        return keyed
    marked = join_small(keyed, repeats, [_KEY, _HASH], "left", salt_by=[F.spark_partition_id()])
    many = marked.where("__again").withColumn("__spread", F.monotonically_increasing_id())
    many = positions(many, ["__spread"], [_KEY, _HASH], pos="__copy")
    own = F.md5(F.concat(F.col(_HASH), F.lit("\n"), F.col("__copy").cast("string")).cast("binary"))
    many = many.withColumn(_HASH, F.when(F.col("__copy") > 1, own).otherwise(F.col(_HASH)))
    return marked.where("__again is null").select(*keyed.columns).unionByName(
        many.select(*keyed.columns))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """(key, source_size) -> + weight, target.  Keys sort by code point, null ("n") last."""
    last = F.when(F.col(_KEY) == "n", 1).otherwise(0)
    rank = F.row_number().over(Window.orderBy(last, _KEY)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = checkpointed(sizes.withColumn("weight", weight))
    whole = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, capped_before = whole / max(1, ranked.agg(F.sum("weight")).first()[0] or 1), 0
    while True:  # each round caps at least one more source
        capped = F.col("weight") * share > max_copies * F.col("source_size")
        n, used, rest = ranked.agg(
            F.sum(F.when(capped, 1).otherwise(0)),
            F.sum(F.when(capped, max_copies * F.col("source_size")).otherwise(0)),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0))).first()
        if not n or n == capped_before or not rest:
            break
        share, capped_before = (whole - used) / rest, n
    return ranked.withColumn("target", F.least(
        F.col("weight") * share, (max_copies * F.col("source_size")).cast("double")))


def solve_dual(sources: DataFrame, steps: int = 100) -> DataFrame:
    """Newton steps for every source at once; adds ``rate`` = exp(multiplier)."""
    now = checkpointed(sources.withColumn("__l", F.when(F.col("target") > 0, F.lit(0.0))))
    for _ in range(steps):
        mass = F.col("source_size") * F.exp("__l")
        gap = now.agg(F.max(F.abs(mass - F.col("target")) / F.col("target"))).first()[0]
        if gap is None or gap < 1e-12:
            break
        before = gap
        now = checkpointed(now.withColumn(
            "__l", F.col("__l") - (mass - F.col("target")) / mass))
        if before < 1e-9:  # converging quadratically, this step was the last
            break
    return now.withColumn("rate", F.coalesce(F.exp("__l"), F.lit(0.0))).drop("__l")


def fit_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """One row a source: sizes, target, rate, and how its documents are rounded.

    ``docs``: (key, size, hash) of the numbered rows, written.
    """
    sizes = docs.groupBy(_KEY).agg(F.sum("size").alias("source_size"))
    rated = solve_dual(source_targets(sizes, weights, max_copies))
    copies = F.floor(F.col("rate") + 1e-9).cast("int")
    rest = (F.col("rate") * F.col("source_size")
            - F.col("copies") * F.col("source_size")).cast("double")
    sources = checkpointed(rated.withColumn("copies", copies).withColumn(
        "rest", F.greatest(rest, F.lit(0.0))))
    # what is joined below has a row for each source too, of at most eight times the bytes
    most = 8 * measured_bytes(sources)

    def beside(rows: DataFrame, small: DataFrame, on: list[str], by: str) -> DataFrame:
        return join_small(rows, small, on, known_bytes=most, salt_by=[by])

    def up_to_rest(rows: DataFrame, asked: DataFrame) -> DataFrame:
        """_KEY, total, and of the documents in hash order: the bucket in which the running
        sum of sizes passes ``rest``, the sum before it, the last document that still fits,
        the sum up to it, and the document after it that doesn't (null: all fit)."""
        bucket = F.substring(_HASH, 1, _BUCKET_DIGITS).alias("bucket")
        sums = rows.groupBy(_KEY, bucket).agg(F.sum("size").alias("s"))
        run = Window.partitionBy(_KEY).orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("s").over(run)).join(asked.select(_KEY, "rest"), _KEY)
        over = F.col("upto") > F.col("rest") + TOL
        edge = sums.groupBy(_KEY).agg(F.max("upto").alias("total"), F.min(F.when(over, F.struct(
            "bucket", (F.col("upto") - F.col("s")).alias("before")))).alias("edge"))
        edge = checkpointed(edge.select(_KEY, "total", "edge.bucket", "edge.before"))

        # inside it, the last document that still fits
        inside = beside(rows.withColumn("bucket", bucket), edge.where("bucket is not null").join(
            asked.select(_KEY, "rest"), _KEY), [_KEY, "bucket"], _HASH)
        order = Window.partitionBy(_KEY).orderBy(_HASH).rangeBetween(
            Window.unboundedPreceding, Window.currentRow)
        inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(order))
        fit = F.col("upto") <= F.col("rest") + TOL
        found = inside.groupBy(_KEY).agg(
            F.max(F.when(fit, F.col(_HASH))).alias("last"),
            F.max(F.when(fit, F.col("upto"))).alias("upto"),
            F.min(F.when(~fit, F.col(_HASH))).alias("next"))
        return edge.join(found, _KEY, "left")

    # hashes up to ``upto_hash`` are in; without an edge all are
    state = sources.join(up_to_rest(docs, sources), _KEY, "left").select(
        *sources.columns,
        F.coalesce("last", "bucket", F.lit("g")).alias("upto_hash"),
        F.when(F.col("bucket").isNull(), 0.0).otherwise(
            F.col("rest") - F.coalesce("upto", "before")).alias("gap"),
        F.lit(None).cast("struct<size:long,hash:string>").alias("last_fill"),
        F.array().cast("array<string>").alias("fills"),
        F.array().cast("array<struct<after:string,upto:string,most:double>>").alias("spans"),
        F.coalesce("next", F.lit("g")).alias("at"))
    state = checkpointed(state)

    # the largest document that fits what is missing, again and again
    open_gap = state.agg(F.max("gap")).first()[0] or 0.0
    if open_gap < 1:
        return state.select(*_MODEL)
    left = beside(docs, state.select(_KEY, "upto_hash", "gap"), [_KEY], _HASH).where(
        (F.col(_HASH) > F.col("upto_hash")) & (F.col("size") > 0)
        & (F.col("size") < 2 * F.col("gap")))
    left = checkpointed(left.select(
        _KEY, F.struct("size", F.col(_HASH).alias("hash")).alias("doc")))

    def add(found: DataFrame) -> DataFrame:
        return checkpointed(state.join(found, _KEY, "left").select(
            *sources.columns, "upto_hash",
            (F.col("gap") - F.coalesce("fill.size", F.lit(0))).alias("gap"),
            F.coalesce("fill", "last_fill").alias("last_fill"),
            F.when(F.col("fill").isNull(), F.col("fills")).otherwise(
                F.array_append("fills", F.col("fill.hash"))).alias("fills"),
            "spans", "at", F.col("fill").isNotNull().alias("__more")))

    def fill(rows: DataFrame) -> bool:
        """Up to FILL_ROUNDS documents a source; True if that may not have been enough."""
        nonlocal state
        more = False
        for _ in range(FILL_ROUNDS):
            fits = beside(rows, state.select(_KEY, "gap", "last_fill"), [_KEY], "doc").where(
                (F.col("doc.size") <= F.col("gap") + TOL)
                & (F.col("last_fill").isNull() | (F.col("doc") < F.col("last_fill"))))
            state = add(fits.groupBy(_KEY).agg(F.max("doc").alias("fill")))
            more = state.agg(F.max("__more")).first()[0]
            state = state.drop("__more")
            if not more:
                break
        return bool(more)

    more, units = fill(left), None
    while more:
        # the same threshold search behind the document that didn't fit; a hash once
        most = 8 * measured_bytes(state)
        if units is None:
            units = checkpointed(left.groupBy(_KEY, F.col("doc.hash").alias(_HASH)).agg(
                F.sum("doc.size").alias("size"), F.max("doc.size").alias("__row")))
        asked = state.withColumn("rest", F.col("gap"))
        behind = beside(units, asked.select(_KEY, "gap", "at", "fills"), [_KEY], _HASH).where(
            (F.col(_HASH) > F.col("at")) & ~F.array_contains("fills", F.col(_HASH)))
        fits = checkpointed(behind.where(F.col("__row") <= F.col("gap") + TOL).select(
            _KEY, "size", _HASH))
        span = F.struct(F.col("at").alias("after"), F.coalesce("last", "bucket", F.lit("g")).alias(
            "upto"), (F.col("gap") + TOL).alias("most"))
        found = state.join(up_to_rest(fits, asked), _KEY, "left")
        state = checkpointed(found.select(
            *sources.columns, "upto_hash",
            (F.col("gap") - F.when(F.col("total").isNull(), 0).when(
                F.col("bucket").isNull(), F.col("total")).otherwise(
                F.coalesce("upto", "before"))).alias("gap"),
            F.lit(None).cast("struct<size:long,hash:string>").alias("last_fill"), "fills",
            F.when(F.col("total").isNull(), F.col("spans")).otherwise(
                F.array_append("spans", span)).alias("spans"),
            F.when(F.col("total").isNull(), F.col("at")).otherwise(
                F.coalesce("next", F.lit("g"))).alias("at")))
        behind = beside(units, state.select(_KEY, "at", "fills"), [_KEY], _HASH).where(
            (F.col(_HASH) > F.col("at")) & ~F.array_contains("fills", F.col(_HASH)))
        more = fill(checkpointed(behind.select(
            _KEY, F.struct("size", F.col(_HASH).alias("hash")).alias("doc"))))
    over = beside(left, state.select(_KEY, "gap", "fills", "spans"), [_KEY], "doc").where(
        (F.col("doc.size") > F.col("gap") + TOL) & (F.col("doc.size") < 2 * F.col("gap") - TOL)
        & ~F.array_contains("fills", F.col("doc.hash"))
        & ~_in_spans(F.col("doc.hash"), F.col("doc.size")))
    state = add(over.groupBy(_KEY).agg(F.min("doc").alias("fill")))
    return state.select(*_MODEL)


def _in_spans(digest: Column, size: Column) -> Column:
    return F.exists("spans", lambda s: (digest > s["after"]) & (digest <= s["upto"])
                    & (size <= s["most"]))


_MODEL = [_KEY, "source_size", "target", "rate", "copies", "upto_hash", "fills", "spans"]


def join_sources(docs: DataFrame, sources: DataFrame) -> DataFrame:
    return join_small(docs, sources, [_KEY], salt_by=[_HASH])


def copies_column() -> Column:
    extra = ((F.col(_HASH) <= F.col("upto_hash")) | F.array_contains("fills", F.col(_HASH))
             | _in_spans(F.col(_HASH), F.col("size")))
    return F.col("copies") + F.when(extra, 1).otherwise(0)


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
                text: str = "text", weights: tuple[int, ...] = WEIGHTS,
                max_copies: int = MAX_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), copies."""
    keyed = checkpointed(with_mix_keys(docs.select(doc_id, source, text), doc_id, source, text)
                         .select(doc_id, "size", _KEY, _HASH))
    repeats = repeated_rows(keyed)
    if repeats is not None:
        keyed = checkpointed(numbered(keyed, repeats))
    joined = join_sources(keyed, fit_mix(keyed.select(_KEY, "size", _HASH), weights, max_copies))
    return joined.withColumn("n_copies", copies_column()).select(
        doc_id, "size", "source_size", "target",
        (F.col("size") * F.col("n_copies")).alias("taken"), F.col("n_copies").alias("copies"))


def apply_mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
              text: str = "text", weights: tuple[int, ...] = WEIGHTS,
              max_copies: int = MAX_COPIES) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it."""
    rows = docs.select(F.struct("*").alias("__row"), doc_id, source, text)
    keyed = with_mix_keys(rows, doc_id, source, text)
    narrow = checkpointed(keyed.select(_KEY, "size", _HASH))
    repeats = repeated_rows(narrow)
    if repeats is not None:
        narrow = checkpointed(numbered(narrow, repeats))
    joined = join_sources(numbered(keyed, repeats), fit_mix(narrow, weights, max_copies))
    repeated = joined.withColumn("__n", copies_column()).where(F.col("__n") > 0)
    return repeated.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(
        "__row.*")
