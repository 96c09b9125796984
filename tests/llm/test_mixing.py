import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillpoint.llm.mixing import SCHEDULES, inverse, mix, training_order


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Water filling, straight from the contract."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + (
        [None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    out, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * rate > 2 * sizes[s]]
        if not over:
            return out | {s: weight[s] * rate for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def check(rows, out):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    want = targets(dict(sizes))
    taken, by_size = Counter(), defaultdict(list)
    for r in out:
        source = None if r.source_key == "1" else r.source_key[1:]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        assert len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions)
        taken[source] += r.taken
        by_size[source].append(r.size)
    for s in sizes:
        assert sorted(by_size[s]) == sorted(size(t) for _, t, x in rows if x == s)
        rest = [size(t) for _, t, x in rows if x == s]
        assert abs(taken[s] - want[s]) <= max(1, nearest_sum(rest, want[s]) + short(rest))


def short(sizes):
    """A short document of the source: three quarters are as long."""
    words = sorted(n for n in sizes if n)
    return words[len(words) // 4] if words else 0


def nearest_sum(sizes, target):
    """How near to the target whole passes and some of the documents can come at all."""
    total = sum(sizes)
    if not total:
        return 0
    rest = target - int(target // total) * total
    sums = 1
    for n in sizes:
        sums |= sums << n
    return min(abs(rest - k) for k in range(total + 1) if sums >> k & 1)


def rows_of(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


@pytest.mark.parametrize("rows_per_bucket", [500, 3])
def test_whole_table(documents, rows_per_bucket):
    out = mix(documents, rows_per_bucket=rows_per_bucket).collect()
    check(rows_of(documents), out)
    first = [r.positions[0] for r in out if r.copies]
    assert first == sorted(first) and all(r.copies for r in out[:len(first)])
    again = mix(documents.repartition(7, "text"), rows_per_bucket=rows_per_bucket).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_edges(edge_docs, no_docs):
    check(rows_of(edge_docs), mix(edge_docs).collect())
    assert mix(no_docs).count() == 0 and training_order(no_docs).count() == 0
    order = training_order(edge_docs)
    assert order.columns == edge_docs.columns
    want = Counter()
    for r in mix(edge_docs).collect():
        want[r.doc_id, r.size] += r.copies
    got = Counter((r.doc_id, size(r.text)) for r in order.collect())
    assert got == +want


def test_training_order(documents):
    out = training_order(documents).collect()
    copies = {r.doc_id: r.copies for r in mix(documents).collect()}
    assert Counter(r.doc_id for r in out) == Counter({k: v for k, v in copies.items() if v})


def test_inverse_of_the_schedule(spark):
    df = spark.range(0, 101).selectExpr("id / 100.0D AS u")
    three = ((0.0, 1.0), (0.25, 3.0), (1.0, 0.5))
    for schedule in (*SCHEDULES, three):
        area = lambda t: sum((min(t, t1) - t0) * (r0 + r0 + (r1 - r0) / (t1 - t0) * (min(t, t1) - t0)) / 2
                             for (t0, r0), (t1, r1) in zip(schedule, schedule[1:]) if t > t0)
        for r in df.withColumn("t", inverse(schedule, df["u"])).collect():
            assert area(r.t) / area(1.0) == pytest.approx(r.u, abs=1e-9)


def test_long_document_does_not_spoil_a_reachable_target(spark):
    """Twelve sources of 100 documents of 100 words and one of 5,000."""
    text = {n: " ".join(["w"] * n) for n in (100, 5000, 2000)}
    rows = [(1000 * s + k, text[5000 if k == 0 else 100], f"s{s:02}")
            for s in range(12) for k in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, wanted = Counter(), {}
    for r in mix(df).collect():
        taken[r.source_key] += r.taken
        wanted[r.source_key] = r.target
    assert {12_500.0} < set(wanted.values())
    assert all(abs(taken[s] - wanted[s]) <= 100 for s in wanted), (taken, wanted)


def test_equal_rows_are_spread_and_taken_in_part(spark):
    rows = [(None, "a b c", "s")] * 700 + [(k, "x " * (k % 40 + 1), "t") for k in range(300)] + [
        (7, "same id, another text", "t"), (7, "same id, a third text", "t"), (8, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(df, rows_per_bucket=10).collect()
    check(rows, out)
    order = training_order(df, rows_per_bucket=10).collect()
    want = Counter()
    for r in out:
        want[r.doc_id, r.size] += r.copies
    assert Counter((r.doc_id, size(r.text)) for r in order) == +want


def test_columns_of_any_name_pass(spark, edge_docs):
    """Every name that the operator uses, as an extra column; rows are counted."""
    names = ["k", "doc", "o", "n", "p", "at", "t", "w", "m", "h", "sk", "size", "bucket", "cls", "zone",
             "positions", "copies", "count", "gap", "cut", "_tie", "_K", "_b", "__p", "__i"]
    plain = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs = plain.withColumns({c: F.lit(f"{c}!") for c in names})
    out = training_order(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.select(plain.columns).collect())) == sorted(
        map(str, training_order(plain).collect()))
    assert all(r[c] == f"{c}!" for r in out.collect() for c in names)


def test_nearest_sum_of_sizes():
    import itertools
    import random

    from tillpoint.llm.mixing import _nearest_sum

    rng = random.Random(7)
    for _ in range(200):
        free, held = (sorted({rng.randint(1, 300) for _ in range(rng.randint(0, 6))}) for _ in "ab")
        gap = rng.uniform(-500, 900)
        sums = [sum(a) - sum(b) for n in range(7) for m in range(7)
                for a in itertools.combinations(free, n) for b in itertools.combinations(held, m)]
        more, less = _nearest_sum(gap, free, held, 4000)
        assert set(more) <= set(free) and set(less) <= set(held)
        assert abs(gap - sum(more) + sum(less)) == pytest.approx(min(abs(gap - x) for x in sums))
    assert _nearest_sum(0.0, [5], [7]) == ([], [])


def test_plans_do_not_grow_with_the_classes_of_length(spark, monkeypatch):
    """The driver holds and replans a plan as often as Spark adapts it."""
    import tillpoint.llm.mixing as mixing

    def plans(sizes):
        rows = [(k, " ".join(["w"] * sizes[k % len(sizes)]), f"s{k % 4}") for k in range(120)]
        made = defaultdict(list)

        def written(df, label, **options):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            made[label].append((len(re.findall(r"\bJoin ", plan)), len(re.findall(r"\bRelation ", plan))))
            return write(df, label, **options)

        monkeypatch.setattr(mixing, "materialize", written)
        check(rows, mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
        return made

    write = mixing.materialize
    few, many = plans([1, 5]), plans([1, 5, 20, 70, 300, 1100])
    assert len(few["mix-cut"]) == 2 and len(many["mix-cut"]) == 6
    assert all(joins <= 3 for joins, _ in many["mix-cut"])
    assert {k: v for k, v in few.items() if k != "mix-cut"} == {
        k: v for k, v in many.items() if k != "mix-cut"}
