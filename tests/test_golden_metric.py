"""MAP@7 of small ranked lists whose average precisions are worked out by hand."""

import pytest

from nextbest.operators import evaluate
from nextbest.sources import records

# id -> (actual, predicted, AP@7)
LISTS = {
    # hits at 1, 2, 3: (1 + 1 + 1) / 3
    11: ("a b c", "a b c d e f g", 1.0),
    # hits at 2 and 4: (1/2 + 2/4) / 2
    12: ("b d", "a b c d e f g", 0.5),
    # a hit at 8 is beyond the list: 0
    13: ("h", "a b c d e f g h", 0.0),
    # hits at 1 and 7 of nine actual items: (1 + 2/7) / min(9, 7)
    14: ("a g q r s t u v w", "a x y z k l g", (1 + 2 / 7) / 7),
    # a repeated prediction counts at its first place only: (1 + 2/3) / 2
    15: ("a c", "a a c", (1 + 2 / 3) / 2),
    # a repeated actual item lengthens the list: (1 + 1) / 3
    16: ("a a b", "a b", 2 / 3),
    # nothing actual, and no prediction line at all
    17: ("", "a b", 0.0),
    18: ("a", None, 0.0),
}


def _records(spark, column):
    lines = [(f"{i},{row[column]}\r",) for i, row in LISTS.items() if row[column] is not None]
    return records.parse_ranked_list(spark.createDataFrame(lines, "value string"))


def test_average_precision_of_every_list(spark):
    got = {r.customer: r.ap for r in evaluate.average_precision_records(
        _records(spark, 0), _records(spark, 1), 7).collect()}
    assert got == pytest.approx({i: row[2] for i, row in LISTS.items()})


def test_mean_over_all_actual_ids(spark):
    m = evaluate.map_at_k_records(_records(spark, 0), _records(spark, 1), 7).first()
    assert m.n_customers == len(LISTS)
    assert m.map_at_k == pytest.approx(sum(row[2] for row in LISTS.values()) / len(LISTS))
