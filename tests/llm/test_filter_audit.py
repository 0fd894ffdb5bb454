import re
from itertools import permutations

import numpy as np

from lexitab.llm import filter_audit
from lexitab.plans.fixtures import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, part string, mask int, n string"
LABELS = "doc_id bigint, quality int, toxic int"


def failures(docs):
    """The failed filters of every row, by the definition."""
    out = []
    for doc, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = any(d is not None and doc is not None and d < doc and (t or "") == text for d, t, _ in docs)
        out.append((len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                    bool(re.search(r"[#$%&*|]", text)), copy))
    return out


def brute(docs, labels):
    """The rows by going through every order of the filters, document by document."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    failed, rows = failures(docs), []
    for part in {lang or "" for _, _, lang in docs}:
        mine = [(f, d in good, d in toxic) for (d, _, lang), f in zip(docs, failed) if (lang or "") == part]
        made, shapley = [], dict.fromkeys(range(5), 0)
        for order in permutations(range(5)):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                shapley[f] += len(gone)
                made.append((f, part, "".join("ABCDE"[i] for i in order), step, len(left), len(gone),
                             sum(m[0][f] for m in mine) - len(gone), sum(m[0][f] and sum(m[0]) == 1 for m in mine),
                             sum(m[1] for m in gone), sum(m[2] for m in gone)))
        rows += [(*r[1:], shapley[r[0]]) for r in made]
    return sorted(rows)


def found(spark, docs, labels, parts=3):
    df = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS).repartition(parts)
    return sorted(map(tuple, filter_audit.audit(df, spark.createDataFrame(labels, LABELS)).collect()))


ODD = [(1, "word " * 250, "en"), (2, " ".join(f"w{i}" for i in range(250)), "en"), (3, " ".join(f"w{i}" for i in range(250)), "de"),
       (3, " ".join(f"w{i}" for i in range(250)), "de"), (4, "", None), (5, None, ""), (6, "  \t\n", "en"), (None, "", "en"), (None, "", "en"),
       (7, "A b" * 40_000 + " #", "fr"), (8, " ".join(["É"] * 300), "fr"), (9, "ABC", "x"), (10, "ABC", "x"), (10, "abc$", "x"),
       (11, "\x1c\x85 a\x0bb\x0cc", "x"), (12, " ".join(f"w{i}" for i in range(200)), "y"), (13, "a " * 99 + " ".join(f"w{i}" for i in range(101)), "y"),
       (14, "W" * 3 + "e" * 97, "y"), (15, "W" * 4 + "\U0001F600" * 96, "y"), (2, "other", "en")]


def test_odd_rows(spark):
    labels = [(2, 1, 1), (3, 0, 1), (3, 1, None), (9, 1, 0), (None, 1, 1), (99, 1, 1), (12, None, None)]
    assert found(spark, ODD, labels) == brute(ODD, [r for r in labels if r[0] is not None])


def test_documents(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in table(spark, SF, "documents").collect()]
    labels = [tuple(r) for r in table(spark, SF, "labels").select("doc_id", "quality", "toxic").collect()]
    assert sorted(map(tuple, filter_audit.op11_filter_audit(spark, SF).collect())) == brute(docs, labels)


def test_no_documents_and_no_labels(spark):
    assert found(spark, [], []) == []
    assert found(spark, ODD[:4], []) == brute(ODD[:4], [])


def test_the_walk_visits_every_subset():
    cells = np.random.default_rng(1).integers(0, 50, (32, 3))
    alive = filter_audit.survivors(cells)
    for active in range(32):
        assert (alive[active] == cells[[m for m in range(32) if not m & active]].sum(axis=0)).all()
