import math

from cabflow.llm import mix_sources as m
from tests.llm.edge_tables import documents


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, capped = sum(sizes.values()), set()
    while True:
        left = budget - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_and_taken(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), s) for i, s in enumerate(["a", "a", "a", "b", "c", "c", None, "b", "d"] * 9)]
    out = m.mix(documents(spark, rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    target = brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    taken = {}
    for r in out:
        assert abs(r["target"] - target[source[r["doc_id"]]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
    longest = {s: max(len(t.split()) for _, t, x in rows if x == s) for s in target}
    assert all(abs(taken[s] - target[s]) <= sum(longest.values()) for s in target)
    assert sum(taken.values()) == sum(sizes.values())  # the budget is spent
    assert sorted(map(tuple, out)) == sorted(map(tuple, m.mix(documents(spark, rows)).collect()))


def test_plan_is_ordered_by_virtual_finish_time(spark):
    plan = m.mix_plan(documents(spark)).collect()
    ordered = sorted((r for r in plan if r["words"]), key=lambda r: r["position"])
    at = 0
    for r in ordered:
        assert r["position"] == at
        at += r["words"]
    finish = [r["finish"] for r in ordered]
    assert finish == sorted(finish)


def brute_mix(rows, weights=(1, 2, 3), epochs=3):
    """Words taken of each row, by the order of finish times and the budget alone."""
    import hashlib

    names = sorted({s for _, _, s in rows if s is not None}) + ([None] if any(s is None for _, _, s in rows) else [])
    copies, budget = [], 0
    for rank, source in enumerate(names):
        mine = [(hashlib.md5(f"mix{i}".encode()).hexdigest(), i, len(t.split()), k) for k, (i, t, s) in enumerate(rows) if s == source]
        size = sum(x[2] for x in mine)
        budget += size
        for epoch in range(epochs):
            at = epoch * size
            for x in sorted(mine):
                at += x[2]
                copies.append((at / weights[rank % len(weights)], rank, epoch, *x))
    taken, at = [0] * len(rows), 0
    for *_, size, k in sorted(copies):
        taken[k] += max(0, min(size, budget - at))
        at += size
    return taken


def mixed_rows(n=400):
    return [(i, " ".join(["w"] * (1 + (i * 7919) % 61)), "abbccccd"[i * 31 % 8]) for i in range(n)]


def test_order_and_budget_decide(spark, monkeypatch):
    """Equal to a loop over the sorted copies; another order takes other words."""
    rows = mixed_rows()
    monkeypatch.setattr(m, "ROWS_PER_BUCKET", 50)
    got = {r["doc_id"]: r["taken"] for r in m.mix(documents(spark, rows)).collect()}
    assert got == {r[0]: t for r, t in zip(rows, brute_mix(rows))}
    other = {r["doc_id"]: r["taken"] for r in m.mix(documents(spark, rows), seed="another").collect()}
    assert other != got
    cut = [r for r in m.mix_plan(documents(spark, rows)).collect() if 0 < r["words"] < r["size"]]
    assert len(cut) <= 1  # the one copy that stands at the end of the budget


def test_rows_without_an_id_and_repeated_rows(spark):
    rows = [(None, "a b c", "s")] * 300 + [(1, "x y", "t")] * 100 + [(None, "", "s")] * 50 + [(2, None, "u")] * 20
    out = m.mix(documents(spark, rows)).collect()
    assert len(out) == 470
    assert sum(r["taken"] for r in out) == 300 * 3 + 100 * 2
    buckets = m.queues(documents(spark, rows), (1, 2, 3), 3, "mix")[0]
    assert buckets.filter("doc_id is null").select("shuffle").distinct().count() == 350


def test_edges(spark):
    out = m.mix(documents(spark))
    assert out.count() == 12
    assert all(r["size"] == 0 and r["taken"] == 0 for r in out.filter("doc_id in (1, 2, 3)").collect())
    assert len({tuple(r) for r in out.filter("doc_id = 5").collect()}) >= 1
    assert m.mix(documents(spark, [])).count() == 0
    only_empty = m.mix(documents(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [r["target"] for r in only_empty] == [0.0, 0.0] and not math.isnan(only_empty[0]["target"])
