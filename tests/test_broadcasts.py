"""Tables that grow with the catalogue do not pass through the driver, however small Spark takes them for."""

import pytest

from marquee.plans import recommend
from marquee.sources.proxies import Proxies


@pytest.mark.parametrize("require_shared", [False, True])
def test_explanations_join_genre_masks_by_a_shuffle(spark, with_conf, require_shared):
    with_conf(spark__sql__autoBroadcastJoinThreshold="10m")
    p = Proxies(spark, "/root/testdata/sf0.001")
    pairs = p.ratings.select("user_id", "movie_id")
    found = recommend.explanations(pairs, p.ratings, p.movies, 3, require_shared)
    text = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
    assert not [line for line in joins if "movie_id" in line or "target_id" in line], joins
