import itertools
import random

from plateworks.llm import paragraphs


def corpus():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(500)]
    line = lambda n: " ".join(rng.choices(words, k=n))
    shared = [line(60) for _ in range(5)]
    rows = []
    for d in range(80):
        own = [line(rng.randint(5, 90)) for _ in range(rng.randint(1, 4))]
        if d % 4 == 0:
            passage = rng.choice(shared).split()
            for _ in range(rng.randint(0, 2)):
                passage[rng.randrange(len(passage))] = "edit"
            own.insert(rng.randrange(len(own) + 1), " ".join(passage))
        rows.append((d, "\n\n".join(own)))
    inner = line(70)
    short = "\n".join(line(15) for _ in range(6))
    rows += [(86, short), (87, short)]
    return rows + [(80, f"{inner}\n{inner}"), (81, None), (82, ""), (83, rows[3][1]), (84, line(20000)), (84, line(45))]


def brute(rows):
    found = []
    for d, text in rows:
        lines, at = [x.lower().split() for x in (text or "").split("\n") if x], 0
        while at < len(lines):
            w, end = lines[at], at + 1
            while len(w) < paragraphs.LEAST_WORDS and end < len(lines) and len(lines[end]) < paragraphs.LEAST_WORDS:
                w, end = w + lines[end], end + 1
            if len(w) >= paragraphs.LEAST_WORDS:
                found.append((d, at, {tuple(w[i : i + 5]) for i in range(len(w) - 4)}))
            at = end
    label = list(range(len(found)))
    find = lambda x: x if label[x] == x else find(label[x])
    for a, b in itertools.combinations(range(len(found)), 2):
        x, y = found[a][2], found[b][2]
        if 100 * len(x & y) >= 75 * len(x | y):
            label[find(b)] = find(a)
    groups = {}
    for n, (d, k, _) in enumerate(found):
        groups.setdefault(find(n), []).append((d, k))
    return {(d, k): (min(g)[0], (d, k) != min(g)) for g in groups.values() if len({d for d, _ in g}) > 1 for d, k in g}


def test_repeats_match_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, id string").repartition(3)
    got = paragraphs.repeated_paragraphs(docs).collect()
    assert {(r.doc_id, r.paragraph): (r.first_doc_id, r.removed) for r in got} == brute(rows)
    texts = dict(rows)
    assert all(len(texts[r.doc_id][r.start : r.end].split()) >= paragraphs.LEAST_WORDS for r in got)
    assert {86, 87} <= {r.doc_id for r in got}  # short lines that repeat together
    left = {r.doc_id: r for r in paragraphs.without_repeats(docs).collect()}
    assert left[83].text == "" or not any(r.doc_id == 83 and not r.removed for r in got)
    assert left[80].text == texts[80] and left[81].text is None and left[0].id == "x"


def test_empty_and_null(spark):
    assert paragraphs.repeated_paragraphs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    line = " ".join(f"x{k}" for k in range(50))
    got = paragraphs.repeated_paragraphs(spark.createDataFrame([(None, line), (2, line), (1, line), (1, line)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.removed) for r in got) == [(1, False), (1, False), (2, True)]


def brute_passages(rows):
    """Words of each document that lie in a run of 50 words found in another."""
    holders, texts = {}, {d: (t or "").lower().split() for d, t in rows}
    for d, w in texts.items():
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i : i + 50]), set()).add(d)
    return {(d, i + k) for d, w in texts.items() for i in range(len(w) - 49) if len(holders[tuple(w[i : i + 50])]) > 1 for k in range(50)}


def test_passages_match_brute_force(spark, tmp_path):
    rng = random.Random(5)
    words = [f"W{k}" for k in range(2000)]
    some = lambda n: rng.choices(words, k=n)
    rows, shared = [], [some(n) for n in (50, 51, 55, 80, 200)] + [some(49)]
    for d in range(60):
        w = some(rng.randint(30, 400))
        for _ in range(d % 3):
            at = rng.randrange(len(w))
            w[at:at] = rng.choice(shared)
        rows.append((d, "".join(x + ("\n" if rng.random() < 0.05 else " ") for x in w)))  # any line ends
    rows += [(60, None), (61, ""), (62, rows[7][1])]
    docs = spark.createDataFrame(rows + [rows[4]], "doc_id long, text string").repartition(3)
    got = paragraphs.repeated_passages(docs).collect()
    want = brute_passages(rows)
    assert want and {(r.doc_id, k) for r in got for k in range(r.pos, r.until)} == want
    texts = dict(rows)
    for r in got:
        run = texts[r.doc_id].split()[r.pos : r.until]
        assert texts[r.doc_id][r.start : r.end].split() == run and " ".join(run) in " ".join(texts[r.first_doc_id].split())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = paragraphs.op3_paragraphs(spark, str(tmp_path)).collect()
    # Every passage is in a row of the query, which by whole paragraphs alone it was not.
    assert all(any(o.doc_id == r.doc_id and o.start <= r.start and o.end >= r.end for o in out) for r in got)
    alone = paragraphs.repeated_paragraphs(docs).collect()
    assert not all(any(o.doc_id == r.doc_id and o.start <= r.start and o.end >= r.end for o in alone) for r in got)


def test_cleaned_documents_hold_no_passage_twice(spark):
    """After ``without_repeats`` no run of 50 words is in two documents, and what was not repeated is still there."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    shared = [rng.choices(words, k=n) for n in (55, 80, 120)]
    rows = []
    for d in range(30):
        w = rng.choices(words, k=rng.randint(60, 200))
        if d % 2:
            at = rng.randrange(len(w))
            w[at:at] = shared[d % 3]
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert brute_passages(rows) and not brute_passages(list(left.items()))
    assert all(left[d] == t for d, t in rows if d % 2 == 0)
    holders = {k: [d for d, t in rows if " ".join(s) in t] for k, s in enumerate(shared)}
    assert all(" ".join(shared[k]) in left[min(ds)] for k, ds in holders.items())
