"""Sets that met in wide lists meet anew by what tells them from a reference."""

import random

import numpy as np
import pytest

from barline.llm import ngram_join


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("num", [50, 80, 90])
def test_entries_bring_links_together(num):
    random.seed(num)
    base = set(range(1000, 1060))
    pool = [base]
    for _ in range(250):
        x = set(random.choice(pool[:40]))
        x -= set(random.sample(sorted(x), random.randint(0, 14)))
        x |= {random.choice([random.randint(0, 80), random.randint(5000, 90000)]) for _ in range(random.randint(0, 14))}
        pool.append(x)
    pool = [set(x) for x in {frozenset(x) for x in pool}]
    sets = [np.sort(np.array(sorted(x), np.uint64)) for x in pool]
    for at in (ngram_join.reference(sets)[0], 7):  # any reference is right
        _, often, many = ngram_join.reference(sets)
        found = [ngram_join.apart(s, sets[at], often, many, num, 100) for s in sets]
        assert [x[0] for x in found] == [100 * len(a & pool[at]) >= num * len(a | pool[at]) for a in pool]
        few, wide = [set(x[1].tolist()) for x in found], [set(x[2].tolist()) for x in found]
        links = 0
        for i, a in enumerate(pool):
            for j, b in enumerate(pool[:i]):
                if 100 * len(a & b) < num * len(a | b) or found[i][0] and found[j][0]:
                    continue
                links += 1
                assert few[i] & wide[j] if found[i][0] else wide[i] & few[j] if found[j][0] else few[i] & few[j]
        assert links > 20


def test_wide_lists_are_parted(spark, monkeypatch):
    random.seed(3)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        w = list(words)
        for at in random.sample(range(150), random.randint(0, 7)):
            w[at] = f"x{random.randint(0, 2000)}"
        rows.append((i, " ".join(w)))
    for i in range(400, 480):  # links among those that are far from the rest
        w = rows[random.randint(0, i - 1)][1].split()
        w[random.randint(0, 149)] = f"y{i}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(146)} for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and jaccard(sets[i], sets[j]) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert 50 < len(set(label)) < 400
    held = []
    blocked = ngram_join._blocked
    monkeypatch.setattr(ngram_join, "_blocked", lambda rest: held.extend(r["count"] for r in rest.groupBy("list").count().collect()) or blocked(rest))

    monkeypatch.setattr(ngram_join, "WIDE", 60)

    def joined(key_rows=ngram_join.KEY_ROWS):
        held.clear()
        got = ngram_join.joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 5, 80, key_rows=key_rows)
        assert [r.component_id for r in got.sort("doc_id").collect()] == label
        return max(held, default=0)

    assert joined() <= 60  # more than 200 before
    joined(50)  # keys in several parts
