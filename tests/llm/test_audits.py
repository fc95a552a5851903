"""The audits of sources and filters against brute force, on odd tables and with every buffer made small."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stackweave.llm import divergence, filter_audit
from stackweave.session import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, fails int, n long, place int, part string"


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(11)
    words = "the of And Straße été 漢字 ÀB x1y beta gamma delta eps zeta $5 50% A B C".split()
    texts = [None, "", " \t\n", "the", "the\x0bof\x0cand", "x" * 200_000, "the " * 50_000]
    texts += [" ".join(rng.choice(words[:4 + k % 15]) for _ in range(rng.choice([3, 40, 199, 200, 260]))) for k in range(150)]
    rows = [(k if k % 19 else None, text, rng.choice(["en", "de", None, ""]), "hot" if k % 3 else f"s{k % 5}" if k % 2 else None) for k, text in enumerate(texts)]
    rows += [(500 + k, texts[20], "en", "hot") for k in range(40)] + rows[30:36] + [(40, "the", "en", "hot")] * 3
    return rows, spark.createDataFrame([r + (9, 9, 9, "clash") for r in rows], SCHEMA).repartition(6)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def told_divergence(rows, least=10):
    kept, count = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        kept[lang or ""].update(set(found))
        count[lang or "", source or ""].update(found)
    out = []
    for lang, source in count:
        terms = [t for t, n in kept[lang].items() if n >= least]
        sources = [s for ln, s in count if ln == lang]
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])

        def p(table, term):
            return 1 + 1_000_000_000 * (table[term] + 2) // (sum(table[t] for t in terms) + 2 * len(terms))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        own = count[lang, source]
        pairs = [(s, sum(f(p(own, t), p(count[lang, s], t)) for t in terms)) for s in sources if s != source]
        high = [(t, f(p(own, t), p(whole, t))) for t in terms if own[t] and p(own, t) > p(whole, t)]
        for part, found, most in (("pair", pairs, None), ("term", high, 10)):
            ranked = sorted(found, key=lambda r: (-r[1], r[0].encode()))[:most]
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def test_divergence(spark, odd):
    rows, table = odd
    found = divergence.audit(table, Scratch(spark, "div"))
    assert sorted(map(tuple, found.select("lang", "source", "part", "item", "value", "rank").collect())) == told_divergence(rows)


def test_blocks_and_runs(monkeypatch):
    """Runs of tiny blocks, merged in tiny batches, give the counts of one pass over all texts."""
    import pyarrow as pa
    rng = random.Random(2)
    rows = [{"lang": rng.choice("ab"), "source": rng.choice("xyz"), "text": " ".join(rng.choice("pqrstu") * rng.randint(1, 3) for _ in range(rng.randint(0, 20)))} for _ in range(200)]
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 7)
    runs = [b for b in divergence.spill_runs(pa.Table.from_pylist(rows).to_batches(max_chunksize=3)) if len(b)]
    assert len(runs) > 20
    for run in runs:
        order = [(r["term"], r["lang"]) for r in run.to_pylist()]
        assert order == sorted(set(order))
    everything = pa.Table.from_batches(runs).sort_by([("term", "ascending"), ("lang", "ascending")])
    merged = [r for b in divergence.merge_runs(everything.to_batches(max_chunksize=2)) for r in b.to_pylist()]
    count, docs = Counter(), Counter()
    for r in rows:
        count.update((r["lang"], w, r["source"]) for w in r["text"].split())
        docs.update((r["lang"], w) for w in set(r["text"].split()))
    assert {(r["lang"], r["term"], r["source"]): r["n"] for r in merged} == {k: n for k, n in count.items() if docs[k[:2]] >= 10}
    assert len(merged) == len({(r["lang"], r["term"], r["source"]) for r in merged})


def told_filters(rows, labels):
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for doc_id, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 bool(re.search(r"[#$%&*|]", text)), doc_id is not None and smallest[text] < doc_id]
        parts[source or ""].append((dict(zip("ABCDE", fails)), doc_id in good, doc_id in toxic))
    out = []
    for part, docs in parts.items():
        removed_by = Counter()
        found = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                removed_by[f] += len(gone)
                failing = sum(d[0][f] for d in docs)
                alone = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                found.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [row + (removed_by[row[1][row[2] - 1]],) for row in found]
    return sorted(out)


def test_filters(spark, odd, monkeypatch):
    rows, table = odd
    marks = [(k, k % 2, k % 3) for k in range(1, 120)] + [(5, 0, 1), (5, None, None), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(filter_audit, "TASK_ROWS", 40)
    found = filter_audit.audit(table, labels, Scratch(spark, "aud"))
    got = sorted(map(tuple, found.select("part", "filter_order", "step", *filter_audit.COUNTS).collect()))
    assert got == told_filters(rows, [m for m in marks if m[0] is not None])


def test_ranges_add_up(monkeypatch):
    """Counts summed over tiny id ranges equal those of one range."""
    import pyarrow as pa
    rng = np.random.default_rng(4)
    table = pa.table({"part": sorted(rng.choice(["", "a", "b"], 500)), "fails": pa.array(rng.integers(0, 32, 500), pa.int32()),
                      "n": rng.integers(1, 4, 500), "good": rng.random(500) < 0.4, "toxic": rng.random(500) < 0.1})
    sums = []
    for rows, size in ((1 << 16, 500), (7, 3), (1, 64)):
        monkeypatch.setattr(filter_audit, "RANGE_ROWS", rows)
        sums.append(sorted(tuple(r.values()) for b in filter_audit._merge(table.to_batches(max_chunksize=size)) for r in b.to_pylist()))
    assert sums[0] == sums[1] == sums[2] and len(sums[0]) == 3 * 5 * 16


def test_galloping():
    rng = np.random.default_rng(9)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 60, rng.integers(0, 50))) for _ in range(4)]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*map(set, map(np.ndarray.tolist, lists))))
        assert filter_audit.difference(lists[0], lists[1]).tolist() == sorted(set(lists[0].tolist()) - set(lists[1].tolist()))


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert divergence.audit(empty, Scratch(spark, "div")).count() == 0
    assert filter_audit.audit(empty, labels, Scratch(spark, "aud")).count() == 0
