import pytest
from pyspark.sql import functions as F

from notepairs.operators import splits as S
from notepairs.sources.sinks import load_or_split, training_columns

TEMPLATE = "{} => {}"


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.range(5003).select(
        F.col("id").cast("string").alias("pair_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("document"), F.lit("s").alias("summary")
    )


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.37, 0.9, 1.0])
def test_first_part_is_exact(pairs, fraction):
    assert pairs.filter(S.first_part(pairs, "pair_id", "s", fraction)).count() == int(5003 * fraction)


def test_first_part_follows_the_shuffle_order(pairs):
    _, cut = S.cut_key(pairs, "pair_id", "s", 0.25)
    keys = sorted(r[0] for r in pairs.select(S.shuffle_key(F.col("pair_id"), "s")).collect())
    assert keys[int(5003 * 0.25) - 1] == cut


def test_splits(pairs):
    rows = S.split_pairs(pairs, 50, seed="a", template=TEMPLATE).select("pair_id", "split", "document").collect()
    sizes = {s: sum(r.split == s for r in rows) for s in ("train", "val", "test")}
    learn = int(5003 * 0.9)
    assert sizes["test"] == 5003 - learn
    safe = [r for r in rows if r.split != "test"]
    assert all(len((r.document + " => s").split()) + 10 < 50 for r in safe)
    assert sizes["train"] == int(len(safe) * 0.9) and len({r.pair_id for r in rows}) == len(rows)
    again = {(r.pair_id, r.split) for r in S.split_pairs(pairs.repartition(3), 50, seed="a", template=TEMPLATE).collect()}
    assert again == {(r.pair_id, r.split) for r in rows}
    other = {(r.pair_id, r.split) for r in S.split_pairs(pairs, 50, seed="b", template=TEMPLATE).collect()}
    assert other != again


def test_ratio_must_add_up(pairs):
    with pytest.raises(ValueError):
        S.split_pairs(pairs, 50, ratio=(0.8, 0.1))


def test_stored_splits_are_reused_only_for_the_same_prompt(spark, pairs, tmp_path):
    path = str(tmp_path / "splits")
    first = load_or_split(pairs, path, TEMPLATE, 50)
    stored = sorted(map(tuple, first.select("pair_id", "split").collect()))
    again = load_or_split(pairs.limit(0), path, TEMPLATE, 50)
    assert sorted(map(tuple, again.select("pair_id", "split").collect())) == stored
    with pytest.raises(ValueError, match="other settings"):
        load_or_split(pairs, path, "other {} {}", 50)
    for other in ({"seed": "5"}, {"learn_fraction": 0.8}, {"ratio": (0.8, 0.2)}, {"pad": 1}, {"counter_name": "letters"}):
        with pytest.raises(ValueError, match="other settings"):
            load_or_split(pairs, path, TEMPLATE, 50, **other)
    with pytest.raises(ValueError, match="max_tokens"):
        load_or_split(pairs, path, TEMPLATE, 20)
    manifest = spark.read.json(f"{path}/manifest").first()
    assert spark.read.parquet(f"{path}/safe_ids").count() == manifest["n_train"] + manifest["n_val"]
    assert manifest["n_train"] + manifest["n_val"] + manifest["n_test"] == len(stored)
    assert training_columns(again, "val").columns == ["document", "summary"]
    assert training_columns(again, "val").count() == manifest["n_val"]


def test_own_counter(pairs):
    kept = S.length_gate(pairs, 40, template=TEMPLATE, counter=F.length)
    assert kept.filter(F.length("document") + 5 + 10 >= 40).count() == 0 and kept.count() > 0
