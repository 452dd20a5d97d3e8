"""By dot product a search with bounds starts where vectors are long, and not only close."""

import numpy as np

from marquee.operators.item_index import ItemIndex
from marquee.operators.topk import top_k
from test_topk import vectors


def test_few_cells_are_left_after_the_first_ones(spark, tmp_path):
    rng = np.random.default_rng(8)
    # Items all around a circle; those on one side are ten times as long, so nobody's best ones are the closest.
    angle = rng.uniform(0, 2 * np.pi, 4000)
    length = np.where(np.abs(angle - np.pi) < 1, 10.0, 1.0)
    items = np.c_[np.cos(angle), np.sin(angle)] * length[:, None]
    asked = np.pi + rng.choice([-1, 1], 50) * rng.uniform(1.2, 1.6, 50)
    users, items = vectors(spark, np.c_[np.cos(asked), np.sin(asked)], "user_id"), vectors(spark, items, "movie_id")
    index = ItemIndex.build(items, str(tmp_path / "items"))
    rows = lambda df: sorted((r["user_id"], r["rank"], r["movie_id"]) for r in df.collect())
    assert rows(index.exact(users, 10, "dot")) == rows(top_k(users, items, 10, "dot"))
    assert index.exact_pairs(users, 10, "dot") < 0.05 * 50 * 4000
