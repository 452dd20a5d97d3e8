import random

from marquee.operators.item_bitmaps import compared_sets, item_bitmaps


def sets_of(rows):
    found = {}
    for user, item in rows:
        if user is not None and item is not None:
            found.setdefault(user, set()).add(item)
    return found


def test_same_sizes_as_sets(spark):
    draw = random.Random(1)
    ids = [0, 1, 2, 32_767, 32_768, 32_769, 70_000, 2_000_000_000, *range(100, 160)]
    tables = [[(draw.randrange(12), draw.choice(ids)) for _ in range(300)] + [(None, 5), (3, None)] for _ in range(2)]
    tables[0] += [(50, i) for i in range(70_000)]  # a user with very many items
    tables[1] += [(60, 1), (50, 5), (50, 69_999), (50, 70_000)]
    a, b = (spark.createDataFrame(t, "user_id int, movie_id int") for t in tables)
    found = {r["user_id"]: tuple(r)[1:] for r in compared_sets(item_bitmaps(a), item_bitmaps(b)).collect()}
    left, right = map(sets_of, tables)
    assert found.keys() == left.keys() | right.keys()
    for user, counts in found.items():
        x, y = left.get(user, set()), right.get(user, set())
        assert counts == (len(x), len(y), len(x & y), len(x | y))
    assert item_bitmaps(a).where("user_id = 50").count() == 4
    assert compared_sets(item_bitmaps(a.limit(0)), item_bitmaps(b.limit(0))).collect() == []
