"""Near copies against alignment of all pairs."""

import random
import re

from nestline.llm import near, queries
from tests.llm.helpers import documents


def shingled(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
    return tuple(w), list(dict.fromkeys(s))


def common(a, b):
    """Longest common sequence by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def brute(texts):
    """Class of every id and links between different word sequences, all pairs compared."""
    shape = {i: shingled(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids, links = sorted(texts), {i: set() for i in texts}
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            (wa, a), (wb, b) = shape[i], shape[j]
            same = wa == wb and (bool(wa) or (texts[i] or "") == (texts[j] or ""))
            if not same:
                shared = len(set(a) & set(b))
                same = 9 * shared >= 4 * (len(a) + len(b)) > 0 and 9 * common(a, b) >= 4 * (len(a) + len(b))
                if same:
                    links[i].add(wb)
                    links[j].add(wa)
            if same:
                label[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in ids}, links


def check(spark, docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = near.near_copies(docs).collect()
    classes, _ = brute(texts)
    assert {r.doc_id: r.class_id for r in rows} == classes
    assert len(rows) == docs.count()
    return rows


def test_query_equals_all_pairs(spark, sf):
    check(spark, queries.table(spark, sf, "documents"))


def test_planted_groups(spark):
    chosen = random.Random(5)
    vocabulary = ["w%d" % i for i in range(4000)]
    passage = [chosen.choice(vocabulary) for _ in range(60)]
    rows, n = [], 0
    for group in range(25):  # chains of small edits, shared passages around them
        words = [chosen.choice(vocabulary) for _ in range(chosen.choice([30, 80, 300]))]
        for _ in range(chosen.choice([1, 2, 3, 14])):
            words = list(words)
            for _ in range(len(words) // 100):
                words[chosen.randrange(len(words))] = chosen.choice(vocabulary)
            rows.append((n, " ".join(words + (passage if group % 3 == 0 else []))))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "!!"), (n + 3, "!!"), (n + 4, "one two"), (n + 5, "One, two"), (n + 6, "same " * 3000),
             (n + 7, "same " * 2900), (n + 8, "x" * 100_000)]
    found = check(spark, documents(spark, rows, extra=("class_id", "one", "sketch", "label")))
    assert len({r.class_id for r in found}) < len(rows)


def test_hot_group_of_different_texts(spark):
    chosen = random.Random(9)
    words = ["w%d" % chosen.randrange(5000) for _ in range(120)]
    rows = [(i, " ".join(words[:i % 110] + [f"z{i}"] + words[i % 110 + 1:])) for i in range(300)]
    found = near.near_copies(documents(spark, rows)).collect()
    assert {r.class_id for r in found} == {0} and len(found) == 300


def test_hub_between_variants_that_are_not_similar(spark):
    chosen = random.Random(31)
    base = ["w%d" % chosen.randrange(9000) for _ in range(400)]
    rows = [(300, " ".join(base))]
    for i in (*range(300), *range(301, 601)):  # each 0.85 similar to the base, about 0.73 to each other
        words = list(base)
        for place in chosen.sample(range(0, 395, 5), 7):
            words[place] = f"z{i}"
        rows.append((i, " ".join(words)))
    found = near.near_copies(documents(spark, rows)).collect()
    classes, links = brute_by_sets(dict(rows))
    assert {r.doc_id: r.class_id for r in found} == classes and set(classes.values()) == {0}
    assert all(1 <= r.n_links <= links[r.doc_id] for r in found)


def brute_by_sets(texts):
    """Class of every id and its number of links, for texts that keep the order of one base."""
    shape = {i: set(shingled(t)[1]) for i, t in texts.items()}
    label, links, ids = {i: i for i in texts}, dict.fromkeys(texts, 0), sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if 9 * len(shape[i] & shape[j]) >= 4 * (len(shape[i]) + len(shape[j])):
                links[i] += 1
                links[j] += 1
                old, new = max(label[i], label[j]), min(label[i], label[j])
                if old != new:
                    label = {k: new if v == old else v for k, v in label.items()}
    return label, links


def test_links_of_small_groups_are_those_of_all_pairs(spark):
    chosen = random.Random(13)
    rows = []
    for group in range(40):
        words = ["w%d" % chosen.randrange(4000) for _ in range(200)]
        for _ in range(group % 7 + 1):
            words = list(words)
            words[chosen.randrange(200)] = f"z{len(rows)}"
            rows.append((len(rows), " ".join(words)))
    _, links = brute_by_sets(dict(rows))
    assert {r.doc_id: r.n_links for r in near.near_copies(documents(spark, rows)).collect()} == links


def test_blocks_of_a_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 64)
    test_hub_between_variants_that_are_not_similar(spark)


def test_unequal_repeats_of_a_line(spark):
    chosen = random.Random(3)
    rows = []
    for n in range(0, 20, 2):  # equal different shingles, one line repeated 2000 times and 3 times
        prose, line = (" ".join("w%d" % chosen.randrange(5000) for _ in range(k)) for k in (100, 6))
        rows += [(n, prose + f" {line}" * 2000), (n + 1, prose + f" {line}" * 3)]
    found = near.near_copies(documents(spark, rows)).collect()
    assert {(r.doc_id, r.class_id, r.n_links) for r in found} == {(i, i - i % 2, 1) for i, _ in rows}


def test_ids_that_are_null_or_repeated_and_no_rows(spark):
    a, b = " ".join(map(str, range(50))), " ".join(map(str, range(100, 150)))
    docs = documents(spark, [(3, a), (3, b), (5, b), (1, a), (1, a), (None, a), (7, "other words are here now")])
    rows = sorted((r.doc_id, r.class_id) for r in near.near_copies(docs).collect())
    assert {r for r in rows if r[0] in (1, 7)} == {(1, 1), (7, 7)} and len(rows) == 6
    assert sorted(r.doc_id or -1 for r in near.one_of_each(docs).collect())[:3] == [-1, 1, 1]
    assert near.near_copies(docs.limit(0)).count() == 0


def test_alignment_needs_order():
    import numpy as np

    a = np.arange(100, dtype=np.uint32)
    assert near.aligned(a, a) == 100
    assert near.aligned(a, np.roll(a, 50)) == 0
    b = a.copy()
    b[[40, 41]] = b[[41, 40]]
    assert near.aligned(a, b) == 99
