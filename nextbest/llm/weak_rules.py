"""Quality rules by weak supervision, in DataFrame operations only.

Every rule looks at one statistic of a text and votes good (1), bad (-1) or
abstains (0).  Expectation-maximisation over the vote patterns estimates how
often each rule gives each vote on good and on bad documents (a naive-Bayes
label model without labels); a document's posterior probability of being good
replaces the usual "every rule must pass".

The statistics are computed inside each row, so the only shuffle is a count of
vote patterns: at most 3^rules rows whatever the corpus, pre-aggregated in
every task.  EM then runs on that small table.

Edge cases: null and empty texts have no words, zero statistics and fail the
base rule; a repeated row gets the same verdict each time; a null doc_id is
kept as null; an empty table gives an empty result.  Extra columns of the input
pass through ``weak_quality`` (but for those named like one of its own) and
``keep_good`` (all of them), and are left out of the query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextbest.llm.common import WHITE, checkpointed, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

#: Low bits of a packed (window hash, position) number, which hold the position: any array's.
_POS_BITS = 31

_W, _H, _N, _C, _P, _LINES = "__w", "__h", "__n", "__c", "__p", "__lines"


def _window_hash(h: Column, i: Column) -> Column:
    """Of the three words from ``i``, whose own hashes are ``h``."""
    return F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2))


def _same_window(w: Column, a: Column, b: Column) -> Column:
    return ((F.get(w, a) == F.get(w, b)) & (F.get(w, a + 1) == F.get(w, b + 1))
            & (F.get(w, a + 2) == F.get(w, b + 2)))


def _with_equal_neighbour(rows: Column, key) -> Column:
    """The entries of a sorted array whose ``key`` equals that of the entry before or after."""
    def beside(x: Column, j: Column) -> Column:
        return F.coalesce(key(x) == key(F.get(rows, j + 1)), F.lit(False)) \
            | F.coalesce(key(x) == key(F.get(rows, j - 1)), F.lit(False))
    return F.filter(rows, beside)


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def add_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the text statistics that the rules read.

    n_repeat_words counts word positions covered by 3-word windows that occur
    at least twice in the text.  Each window's hash and position are packed into
    one long and sorted as primitives.  Windows whose hash bits meet another's
    are the candidates; if all that stand side by side with equal bits are equal
    word by word, they are the repeated ones, else (hashes that collide may
    stand in between) the candidates are put in order by their words.  So the
    count is exact for texts of any size and for any hashes.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    mask = (1 << _POS_BITS) - 1
    df = docs.withColumn(_W, words(F.col(text)))
    df = df.withColumn(_N, F.size(_W)).withColumn(_H, F.transform(_W, lambda w: F.xxhash64(w)))
    w = F.col(_W)
    at = F.when(F.col(_N) >= 4, F.sequence(F.lit(0), F.col(_N) - 3)).otherwise(
        F.array().cast("array<int>"))
    packed = F.sort_array(F.transform(at, lambda i: F.shiftleft(F.shiftright(
        _window_hash(F.col(_H), i), _POS_BITS), _POS_BITS).bitwiseOR(i.cast("long"))))
    df = df.withColumn(_P, packed)

    def bits(x: Column) -> Column:
        return F.shiftright(x, _POS_BITS)

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(mask)).cast("int")

    df = df.withColumn(_C, _with_equal_neighbour(F.col(_P), bits))
    c = F.col(_C)
    differ = F.filter(c, lambda x, j: F.coalesce(
        (bits(x) == bits(F.get(c, j + 1)))
        & ~_same_window(w, place(x), place(F.get(c, j + 1))), F.lit(False)))
    spelled = F.sort_array(F.transform(c, lambda x: F.struct(
        F.concat_ws(" ", F.get(w, place(x)), F.get(w, place(x) + 1), F.get(w, place(x) + 2))
        .alias("window"), place(x).alias("at"))))
    df = df.withColumn(_P, F.when(F.size(differ) == 0, F.sort_array(
        F.transform(c, place))).otherwise(F.sort_array(F.transform(
            _with_equal_neighbour(spelled, lambda x: x["window"]), lambda x: x["at"]))))
    covered = F.aggregate(
        F.transform(F.col(_P), lambda p, j: F.least(
            F.lit(3), F.coalesce(F.get(F.col(_P), j + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", covered)
    df = df.withColumn(_LINES, F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    bare = F.translate(t, WHITE, "")
    return (df.withColumn("n_words", F.col(_N).cast("long"))
            .withColumn("word_chars", F.length(bare).cast("long"))
            .withColumn("n_symbols", _count_chars(t, SYMBOLS).cast("long"))
            .withColumn("n_lines", F.size(_LINES).cast("long"))
            .withColumn("n_dup_lines", (F.size(_LINES) - F.size(F.array_distinct(_LINES)))
                        .cast("long"))
            .withColumn("n_repeat_next", F.size(F.filter(
                w, lambda x, j: F.coalesce(x == F.get(w, j + 1), F.lit(False)))).cast("long"))
            .withColumn("n_upper", _count_chars(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long"))
            .withColumn("n_marks", _count_chars(t, "!?").cast("long"))
            .withColumn("n_stops", _count_chars(t, ".").cast("long"))
            .drop(_W, _H, _N, _C, _P, _LINES))


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) where ``bad`` holds, else good (1) where ``good`` holds, else abstains (0).

    Both are SQL conditions on the integer statistics, so Spark and any other
    SQL engine agree on every vote.
    """

    name: str
    bad: str = "false"
    good: str = "false"

    def sql(self) -> str:
        return f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END"


#: Each defect has two related rules that can confirm each other; a rule that
#: sees no defect abstains, as one clean statistic says little about the rest.
DEFAULT_RULES = (
    Rule("symbols", "100 * n_symbols >= 20 * n_words AND n_words > 0"),
    Rule("symbol_chars", "100 * n_symbols >= 4 * word_chars AND n_words > 0"),
    Rule("repeats", "100 * n_repeat_words >= 30 * n_words AND n_words > 0"),
    Rule("stutter", "100 * n_repeat_next >= 15 * n_words AND n_words > 0"),
    Rule("lines", "100 * n_dup_lines >= 40 * n_lines AND n_lines > 1"),
    Rule("upper", "100 * n_upper >= 30 * word_chars AND n_words > 0"),
    Rule("marks", "100 * n_marks >= 20 * n_words AND n_words > 0"),
    Rule("long_words", "word_chars >= 15 * n_words OR word_chars < 2 * n_words"),
    Rule("prose", good="100 * n_symbols <= 5 * n_words AND 100 * n_upper <= 15 * word_chars"
         " AND 100 * n_marks <= 10 * n_words AND 100 * n_repeat_words <= 20 * n_words"
         " AND 100 * n_repeat_next <= 10 * n_words AND n_words > 0"),
)


@dataclass(frozen=True)
class LabelModel:
    """Prior of good, and each rule's accuracy when it votes."""

    prior: float
    accuracy: dict[str, float]


#: EM starts from this prior and accuracy; they also smooth each estimate as
#: PSEUDO documents would, so a rule that never votes keeps its start value.
START_PRIOR = 0.8
START_ACCURACY = 0.85
PSEUDO = 10
ITERATIONS = 12


def start_model(rules: tuple[Rule, ...]) -> LabelModel:
    return LabelModel(START_PRIOR, {r.name: START_ACCURACY for r in rules})


def vote_columns(rules: tuple[Rule, ...]) -> list[Column]:
    return [F.expr(r.sql()).cast("int").alias(f"vote_{r.name}") for r in rules]


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def log_odds(model: LabelModel, rules: tuple[Rule, ...]) -> Column:
    """Log odds of good: the prior's, plus vote times the rule's own log odds."""
    total = F.lit(_logit(model.prior))
    for r in rules:
        total = total + F.lit(_logit(model.accuracy[r.name])) * F.col(f"vote_{r.name}")
    return total


def fit_label_model(patterns: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES,
                    iterations: int = ITERATIONS) -> LabelModel:
    """EM over the pattern table (at most 3^rules rows); one small job a step.

    E: posterior of good for each pattern.  M: the prior is the mean posterior,
    a rule's accuracy the mean posterior of its votes.  Votes are taken as
    independent given the class and abstaining as uninformative.
    """
    model = start_model(rules)
    for _ in range(iterations):
        good = F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds(model, rules)))
        soft = patterns.withColumn("__good", good)
        sums = [F.sum("n").alias("n"), F.sum(F.col("__good") * F.col("n")).alias("good")]
        for r in rules:
            vote = F.col(f"vote_{r.name}")
            right = F.when(vote == 1, F.col("__good")).when(vote == -1, 1 - F.col("__good"))
            sums += [F.sum(F.when(vote != 0, F.col("n"))).alias(f"n_{r.name}"),
                     F.sum(right * F.col("n")).alias(f"right_{r.name}")]
        row = soft.agg(*sums).first()
        prior = ((row["good"] or 0.0) + PSEUDO * START_PRIOR) / ((row["n"] or 0) + PSEUDO)
        model = LabelModel(prior, {
            r.name: ((row[f"right_{r.name}"] or 0.0) + PSEUDO * START_ACCURACY)
            / ((row[f"n_{r.name}"] or 0) + PSEUDO) for r in rules})
    return model


def weak_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = DEFAULT_RULES,
                 min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
                 threshold: float = 0.5, iterations: int = ITERATIONS,
                 keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all of ``docs``) + statistics + verdict.

    An input column named like a result column gives way to it.  Rows, votes and
    statistics are written once, so fitting and scoring read the texts once.
    """
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own = {*numbers, "posterior", "base_failed", "kept", *(f"vote_{r.name}" for r in rules)}
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in own]
    rows = docs.select(F.struct(*cols).alias("__row"), F.col(text).alias("__text")) if cols else \
        docs.select(F.struct(F.lit(0)).alias("__row"), F.col(text).alias("__text"))
    scored = checkpointed(add_statistics(rows, "__text").select(
        "__row", *numbers, *vote_columns(rules)))
    scored = scored.select(*(["__row.*"] if cols else []), *numbers,
                           *[f"vote_{r.name}" for r in rules])
    names = [f"vote_{r.name}" for r in rules]
    patterns = scored.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    model = fit_label_model(checkpointed(patterns.coalesce(1)), rules, iterations)
    posterior = F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds(model, rules)))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))
    return (scored.withColumn("posterior", posterior).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))


def keep_good(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that the verdict keeps, with all their columns, whatever their names."""
    rows = docs.select(F.struct("*").alias("__input"), F.col(text).alias("__text"))
    return weak_quality(rows, "__text", keep=["__input"], **settings).where(
        F.col("kept")).select("__input.*")
