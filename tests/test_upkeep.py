"""A manifest after deltas equals the manifest made anew."""

import random

from quern.operators import master, upkeep

SCHEMA = "id long, klass string, corpus string, fingerprint string, is_valid boolean, n_chars long"
ORDER = ["corpus", "klass", "id"]


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_deltas_equal_a_manifest_made_anew(spark, tmp_path):
    rng, root, items = random.Random(2), f"file://{tmp_path}/manifest", {}

    def item(i):
        return (i, rng.choice("ab"), rng.choice("AB"), rng.choice([None, *(f"f{k}" for k in range(25))]), rng.random() < 0.8, rng.randrange(100))

    for step in range(7):
        fresh = [item(i) for i in rng.sample(range(100), 30 if step else 40)]
        removed = rng.sample(sorted(items), 6) if step else []
        removed = [i for i in removed if i not in {r[0] for r in fresh}] + ([10**6] if step == 2 else [])
        delta, out = spark.createDataFrame(fresh, SCHEMA), spark.createDataFrame([(i,) for i in removed], "id long")
        items |= {r[0]: r for r in fresh}
        for i in removed:
            items.pop(i, None)
        assert upkeep.update(root, delta, ORDER, out, compact_after=4) is not None
        want = master.manifest(spark.createDataFrame(list(items.values()), SCHEMA), ORDER)
        assert rows_of(upkeep.current(spark, root), want.columns) == rows_of(want, want.columns)
        assert len(upkeep.layers(spark, root)) <= 4
    known = upkeep.layers(spark, root)
    again = spark.createDataFrame(rng.sample(sorted(items.values()), 20), SCHEMA)
    assert upkeep.update(root, again, ORDER) is None
    assert upkeep.update(root, again.limit(0), ORDER, again.select((again.id + 10**7).alias("id"))) is None
    assert upkeep.layers(spark, root) == known


def test_nothing_is_written_for_no_items(spark, tmp_path):
    root = f"file://{tmp_path}/none"
    assert upkeep.update(root, spark.createDataFrame([], SCHEMA), ORDER) is None
    assert upkeep.layers(spark, root) == []
