import pytest

from itemsync.llm import mixing
from tests.llm.conftest import nasty_texts


@pytest.mark.parametrize("shares", [[1], [1, 1], [7, 2, 1], [13, 11, 5, 1, 1], [8, 4, 4, 2, 2] + [1] * 15, [997, 3, 1]])
def test_deviation_is_below_one_block(shares):
    placed, total = mixing.period(shares), sum(shares)
    order = {slot: i for i, slots in enumerate(placed) for slot in slots}
    assert sorted(order) == list(range(total))
    done = [0] * len(shares)
    for slot in range(total):
        done[order[slot]] += 1
        for i, share in enumerate(shares):
            assert abs(done[i] * total - (slot + 1) * share) < total
    for share, slots in zip(shares, placed, strict=True):
        for k, slot in enumerate(slots, 1):
            assert (k - 1) * total // share <= slot < -(-k * total // share)


def test_shares_must_be_positive():
    with pytest.raises(ValueError):
        mixing.period([0, 1])


def mix_of(spark, rows, shares, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, slot string").repartition(4)
    out = mixing.mixed(docs, shares, block_rows=4, **options).orderBy("position").collect()
    assert len(out) == len(rows) == len({r.position for r in out})
    return out


def test_every_row_has_its_place_and_every_source_its_share(spark):
    rows = [(n, [*"aaabbcdefghijklmnopqrst"][n % 23], "x") for n in range(2400)]
    rows += [(None, "a", "x"), (5, "a", "x"), (5, "a", "x")] + [(n, None, "x") for n in range(100)]
    named = {"a": 3, "b": 2, "nowhere": 9}
    share = {s: named.get(s, 1) for s in [None, *"abcdefghijklmnopqrst"]}
    total = sum(share.values())
    out = mix_of(spark, rows, named)
    mix = [r for r in out if r.in_mix]
    assert [r.position for r in mix] == list(range(len(mix))) and len(mix) % 4 == 0 and len(mix) > 300
    done = dict.fromkeys(share, 0)
    for n, r in enumerate(mix, 1):
        done[r.source] += 1
        if n % 4 == 0:
            assert all(abs(done[g] - n * s / total) < 4 for g, s in share.items())
    # behind the mix, every source keeps its own order without gaps
    for g in share:
        own = [(r.slot, r.place) for r in out if r.source == g]
        assert [p for _, p in own] == [n % 4 for n in range(len(own))]


def test_more_sources_than_shares(spark, monkeypatch):
    """The sources of the fewest rows are dealt together where the period would be too long."""
    monkeypatch.setattr(mixing, "MOST_SHARES", 6)
    rows = [(n, "abcdefghij"[min(9, n % 17)], "x") for n in range(600)] + [(n, "rare", "x") for n in range(3)]
    out = mix_of(spark, rows, {"a": 2})
    groups = {r.slot % 6: set() for r in out}
    for r in out:
        groups[r.slot % 6].add(r.source)
    assert sorted(len(g) for g in groups.values()) == [1, 1, 1, 1, 1, 7]
    assert any({"rare", "e"} <= g for g in groups.values())


def test_nulls_and_empty(nasty, empty):
    out = mixing.mixed(nasty, {"a": 1}, other=2)
    assert out.count() == len(nasty_texts()) and out.select("position").distinct().count() == len(nasty_texts())
    assert mixing.mixed(empty, {"a": 1}).count() == 0
