import random

import numpy as np

from rosterline.llm.mixing import fit_budget, mix_sources, targets

SCHEMA = "doc_id long, text string, source string, n long, size int"


def brute_best(lengths, counts, budget):
    sums = {0}
    for size, n in zip(lengths, counts):
        for _ in range(n):
            sums |= {s + size for s in sums if s + size <= budget}
    return max(sums)


def test_targets_share_all_and_stop_at_three_times():
    sizes = [10, 1000, 0, 500]
    got = targets(sizes, [5.0, 2.0, 1.0, 5.0])
    assert got[0] == 30 and got[2] == 0 and abs(sum(got) - sum(sizes)) < 1e-6
    assert all(g <= 3 * s + 1e-9 for g, s in zip(got, sizes))
    assert abs(got[1] / got[3] - 2 / 5) < 1e-9


def test_the_fit_is_the_best_sum():
    r = random.Random(1)
    for _ in range(60):
        lengths = sorted(r.sample(range(1, 60), r.randint(1, 5)))
        counts = [r.randint(1, 4) for _ in lengths]
        budget = r.randint(0, int(np.dot(lengths, counts)))
        take = fit_budget(np.array(lengths), np.array(counts), budget)
        got = int(np.dot(lengths, take))
        assert (take <= counts).all() and (take >= 0).all() and got <= budget
        # the proportional part is fixed first, so the fit is the best one over what it leaves
        fixed = np.array([c * budget // int(np.dot(lengths, counts)) for c in counts])
        assert got == int(np.dot(lengths, fixed)) + brute_best(lengths, (np.array(counts) - fixed).tolist(), budget - int(np.dot(lengths, fixed)))


def test_each_source_comes_near_its_target(spark):
    r = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 40))), r.choice(["a", "b", "b", "b", "é", None]), 1, 1) for i in range(1500)]
    rows += [(9000, None, "a", 1, 1), (9001, "", None, None, None), (None, "x y", "a", None, None), (5, "dup dup", "zz", 1, 1), (5, "dup dup", "zz", 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix_sources(docs).collect()
    again = mix_sources(docs.repartition(7)).collect()
    key = lambda x: (str(x["source"]), x["doc_id"] or -1, x["mix_taken"])
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    by = {}
    for x in got:
        assert x["mix_size"] == len((x["text"] or "").split()) and x["mix_taken"] <= 3 * x["mix_size"]
        assert x["mix_taken"] == 0 or x["mix_taken"] % x["mix_size"] == 0
        t = by.setdefault(x["source"], [x["mix_target"], 0, x["mix_source_size"], 0])
        t[1] += x["mix_taken"]
        t[3] += x["mix_size"]
    assert all(abs(a - b) <= 1 and c == d for a, b, c, d in by.values())
    assert mix_sources(docs.limit(0)).count() == 0


def test_all_lengths_have_their_share():
    r = random.Random(3)
    lengths = np.array(sorted(r.sample(range(20, 2000), 280) + r.sample(range(2000, 20000), 70)))
    counts = np.array([r.choice([1, 1, 1, 2]) for _ in lengths])
    words = lengths * counts
    budget = int(words.sum()) * 2 // 5
    seen = set()
    for seed in range(20):
        take = fit_budget(lengths, counts, budget, seed=seed)
        assert (take <= counts).all() and (take >= 0).all() and int(np.dot(lengths, take)) == budget
        for part in np.array_split(np.arange(len(lengths)), 5):
            assert abs(take[part].sum() / counts[part].sum() - 0.4) < 0.12
        assert take[-25:].sum() < 0.7 * counts[-25:].sum()
        seen.add(tuple(take.tolist()))
    assert len(seen) == 20


def test_a_rest_of_long_documents_is_fitted():
    lengths, counts = np.array([3 * 70001, 3 * 90001, 3 * 100003, 3 * 110017]), np.array([1, 1, 1, 1])
    budget = 3 * (70001 + 100003)
    assert max(int(np.dot(lengths, fit_budget(lengths, counts, budget, seed=s))) for s in range(20)) == budget


def test_long_documents_are_taken_if_they_fit():
    assert fit_budget(np.array([66000, 70000]), np.array([3, 3]), 70500).tolist() == [0, 1]
    take = fit_budget(np.array([70000, 200000, 3_000_000]), np.array([4, 1, 1]), 3_270_000)
    assert 3_200_000 <= int(np.dot(take, [70000, 200000, 3_000_000])) <= 3_270_000
