import random
import re

from panelforge.llm.jaccard import jaccard_join

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ti to".split()


def prose(r, n):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    """{id: (size, component)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    home = {i: i for i in sets}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                home[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(found, rows):
    expected = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected


def test_brute_force_with_large_groups_and_common_passages(spark):
    """Near copies in chains, passages shared by many, regions beyond every limit."""
    r = random.Random(1)
    passage, line = prose(r, 40), prose(r, 9)
    texts = [prose(r, r.choice([5, 12, 30, 80])) for _ in range(60)]
    texts += [prose(r, 15) + " " + passage + " " + prose(r, 15) for _ in range(30)]
    texts += [passage + " " + prose(r, r.randint(1, 8)) for _ in range(25)]
    texts += [line + "\n" + prose(r, 20) for _ in range(25)]
    for _ in range(3):
        w = prose(r, 70).split()
        for _ in range(40):
            w = list(w)
            if r.random() < 0.6:
                w[r.randrange(len(w))] = "edit" + str(r.randrange(99))
            v = list(w)
            for _ in range(r.randrange(4)):
                v[r.randrange(len(v))] = "x" + str(r.randrange(999))
            texts.append(" ".join(v))
    rows = list(enumerate(texts))
    r.shuffle(rows)
    found = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), region_rows=400, wide=12).collect()
    assert len(found) == len(rows)
    check(found, rows)


def test_odd_rows(odd_docs):
    rows = [(x.doc_id, x.text) for x in odd_docs.collect()]
    found = jaccard_join(odd_docs).collect()
    assert len(found) == len(rows)
    check(found, [x for x in rows if x[0] is not None])
    assert [(x.class_id, x.component_id) for x in found if x.doc_id is None] == [(None, None)]


def test_empty(no_docs):
    assert jaccard_join(no_docs).count() == 0
