"""Operators on documents against brute force, and their behaviour on odd tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stackweave.llm import bpe, exact_dedup, langid, mixing, quality, secrets, simhash
from stackweave.session import Scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ("score", "kept", "fp", "salt", "norm", "_sha", "_fp", "_words", "size", "key", "row", "n_tokens", "stats", "lang_pred")
SPACE = r"[\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, repeats, ties, a very long text, a hot source and clashing columns."""
    rng = random.Random(5)
    words = "the of and token alpha beta gamma é 漢字 🙂 AKIA secret= 0123456789abcdef0 <|endoftext|> don't A.B 42 \x01 x|y".split(" ")
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n", "en", None, 3), (4, "one", "en", "b", 3), (4, "one", "en", "b", 3)]
    rows += [(None, "one", "en", "b", 3), (None, "only null id", "en", "b", 3), (None, "only null id", "en", "b", 3), (5, "long word " + "ab" * 60_000, "en", "c", 9)]
    for k in range(10, 260):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", " ", "\r\n", " "]) for _ in range(rng.randint(1, 60)))
        rows.append((k, text, rng.choice(["en", "de", None]), "hot" if k % 3 else f"s{k % 7}", len(text)))
    rows += [(1000 + k, rows[20][1].replace(" ", "  "), "en", "hot", 1) for k in range(60)]
    base = " ".join(rng.choice(words) for _ in range(400))
    for k in range(40):
        changed = base.split(" ")
        changed[rng.randrange(400)] = f"w{k % 20}"
        rows.append((2000 + k, " ".join(changed), "en", "hot", 1))
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return rows, table.select("*", *[F.lit("extra").alias(n) for n in EXTRA])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tuples(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def normal(text):
    return re.sub(SPACE, " ", text or "")


def test_exact_dedup(spark, odd):
    rows, table = odd
    classes = {}
    for doc_id, text, *_ in rows:
        classes.setdefault(normal(text), []).append(doc_id)
    want = []
    for doc_id, text, *_ in rows:
        own = classes[normal(text)]
        keep = min((i for i in own if i is not None), default=None)
        want.append((doc_id, keep, len(own), keep is None or doc_id == keep, hashlib.sha256(normal(text).encode()).hexdigest()))
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert tuples(exact_dedup.dedup(table, Scratch(spark, "t")), *names) == sorted(want, key=repr)
    # A weak digest: only the content tells the classes apart.
    weak = exact_dedup.dedup(table, Scratch(spark, "t"), salts=3, digest=lambda norm: F.length(norm) % 3)
    assert tuples(weak, *names) == sorted(want, key=repr)


def test_exact_dedup_keeps_one_of_each(spark, odd):
    rows, table = odd
    kept = exact_dedup.keep_first(table, Scratch(spark, "t"))
    assert kept.columns == table.columns
    got = kept.collect()
    assert sorted(normal(r["text"]) for r in got) == sorted({normal(r[1]) for r in rows})
    assert all(r["_sha"] == "extra" for r in got)


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), seed=42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance):
    """Smallest id reachable over pairs within the distance, for {id or None: print} pairs."""
    values = np.array([p for _, p in prints], dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    low = np.array([2**62 if i is None else i for i, _ in prints])
    while True:
        new = np.where(near, low[None, :], 2**62).min(axis=1)
        if (new == low).all():
            return [None if x == 2**62 else int(x) for x in low]
        low = new


def test_simhash_groups(spark, odd):
    rows, table = odd
    prints = [(r[0], plain_print(r[1])) for r in rows]
    want = [(i, p if p < 1 << 63 else p - (1 << 64), g) for (i, p), g in zip(prints, plain_groups(prints, 4))]
    assert tuples(simhash.groups(table, Scratch(spark, "t")), "doc_id", "fp", "component_id") == sorted(want, key=repr)
    kept = simhash.keep_one(table, Scratch(spark, "t"))
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {g for _, _, g in want}


@pytest.mark.parametrize("distance", [0, 1, 4, 6])
@pytest.mark.parametrize("most", [7, 20_000])
def test_links_of_dense_balls(spark, rng, distance, most):
    """Many fingerprints around few centres; small limits force the splitting of keys."""
    prints = {0, 1, 3, 2**64 - 1}
    for centre in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(25):
            own = centre
            for bit in rng.choice(64, rng.integers(0, 7), replace=False).tolist():
                own ^= 1 << bit
            prints.add(own)
    prints = np.array(sorted(prints), dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.links(df, Scratch(spark, "t"), distance, most).collect()
    parent = {p: p for p in prints}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= distance
        parent[max(top(a), top(b))] = min(top(a), top(b))
    named = {p: k for k, p in enumerate(prints)}
    want = plain_groups([(named[p], p & (2**64 - 1)) for p in prints], distance)
    tops = {}
    got = [tops.setdefault(top(p), named[p]) for p in prints]
    assert got == want


def test_mixing_targets_and_takes(spark, odd):
    rows, table = odd
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = {}
    for _, text, _, source, _ in rows:
        totals[source] = totals.get(source, 0) + size(text)
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(totals.values()))
    while True:  # share, cap, share the excess again
        level = left / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if level * weights[s] > 3 * totals[s]}
        if not over:
            break
        for s in over:
            target[s], left = 3.0 * totals[s], left - 3.0 * totals[s]
        free -= over
    target |= {s: level * weights[s] for s in free}
    found = mixing.mix(table, Scratch(spark, "t")).collect()
    assert sorted((r["doc_id"], r["source"], r["size"]) for r in found if r["doc_id"] and r["source"]) == sorted((i, s, size(t)) for i, t, _, s, _ in rows if i and s)
    taken = {}
    for r in found:
        assert r["source_size"] == totals[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        words = r["epochs"] * r["size"] + r["part"]
        assert 0 <= words <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + words
    assert all(abs(taken[s] - target[s]) < 1 for s in names)
    again = mixing.mix(table.repartition(3), Scratch(spark, "t"))
    assert tuples(again, "doc_id", "size", "epochs", "part") == sorted([(r["doc_id"], r["size"], r["epochs"], r["part"]) for r in found], key=repr)


def test_mixing_with_many_bins_takes_in_key_order(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_ROWS", 10)
    rows = [(k, "w " * (1 + k % 9), None, "a" if k % 4 else "b", 0) for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    keys = docs.select("doc_id", (mixing.sampling_key(9, "doc_id", "source") / mixing.letter_share(F.col("text"))).alias("k"))
    found = mixing.mix(docs, Scratch(spark, "t")).join(keys, "doc_id").collect()
    for source in "ab":
        own = sorted((r for r in found if r["source"] == source), key=lambda r: r["k"])
        rest = round(own[0]["target"] - own[0]["epochs"] * own[0]["source_size"])
        for r in own:
            assert r["part"] == min(r["size"], max(0, rest))
            rest -= r["size"]


def test_mixed_rows(spark, odd):
    rows, table = odd
    got = mixing.mixed(table, Scratch(spark, "t"))
    assert got.columns == table.columns
    texts = {r[1] for r in rows}
    assert all(r["text"] in texts for r in got.collect())


def test_heavier_documents_come_first(spark):
    """Efraimidis-Spirakis: the chance to be among the first grows with the weight."""
    docs = spark.createDataFrame([(k, "w", None, "a" if k % 2 else "b", 0) for k in range(8000)], SCHEMA)
    weight = F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0)
    found = mixing.mix(docs, Scratch(spark, "t"), weight=weight).where("source = 'b'").collect()
    first = [r for r in found if r["part"]]
    heavy = sum(r["doc_id"] % 4 < 2 for r in first)
    assert heavy > 1.5 * (len(first) - heavy)


def test_bpe_equals_the_library(spark, odd):
    rows, table = odd
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    found = bpe.tokenised(table, VOCABULARY, with_ids=True)
    assert tuples(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert all(r["decoded"] == (r["text"] or "") and len(r["ids"]) == r["n_tokens"] for r in found.collect())


def test_bpe_on_random_signs():
    rng, library, own = random.Random(1), Tokenizer.from_file(VOCABULARY), bpe.tokenizer(VOCABULARY)
    signs = [chr(c) for c in range(33)] + list(" \x85\xa0　​﻿ 'sSt<|>éñ漢🙂́١²ⅧABab01.,!\x1c᠎") + ["<|endoftext|>", "'ll", " the"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choices("abthe", k=n)) for n in (1, 95, 96, 97, 98, 300, 3000)]
    for text, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(packed) == text


def test_secrets_base_spans(spark, odd):
    rows, table = odd
    patterns = (("assign", re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 12),
                ("access", re.compile("AKIA[A-Z0-9]+"), 18), ("hex", re.compile("[0-9a-f]+"), 16))
    rng = random.Random(4)
    parts = ["token", "SECRET", "api_key", " ", "=", ":", '"', "'", "abcdefabcdef0123", "deadbeefdeadbeef99", "AKIA", "ABCDEFGHIJKLMNOP", "é", "🙂", "\x01", "\x02", "\n", "PassWord", "hunter2hunter2", "$1", "\\"]
    more = [(5000 + k, "".join(rng.choices(parts, k=rng.randint(0, 25))), None, f"s{k % 5}", 0) for k in range(400)]
    rows = rows + more
    found = secrets.digest(table.select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, SCHEMA).select("doc_id", "text", "source")), Scratch(spark, "t"))
    want = []
    for doc_id, text, *_ in rows:
        spans = []
        for rank, (kind, pattern, least) in enumerate(patterns):
            for m in pattern.finditer(text or ""):
                if len(m.group(2) if kind == "assign" else m.group()) >= least:
                    spans.append((m.start(), rank, m.end(), kind))
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        want.append((doc_id, *(sum(s[3] == k for s in spans) for k, _, _ in patterns), hashlib.sha256(joined.encode()).hexdigest()))
    assert tuples(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=repr)


def test_secrets_ownership(spark):
    live, copied = "q7Zr9PwLx2VbN4", "EXAMPLE0KEY1ab2"
    rows = [(k, f"x token={copied} y", None, f"s{k}", 0) for k in range(4)] + [(10, f"token: {live}", None, "s1", 0), (11, f"token: {live}", None, "s1", 0), (12, "token=aaaaaaaaaaaaaaaa", None, "s9", 0)]
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t")).collect()}
    assert got[0] == "assign:2:23,example:8:23"
    assert got[10] == got[11] == "assign:0:21,live:7:21"
    assert got[12] == "assign:0:22,hex:6:22,weak:6:22"


def labelled(rows):
    good = lambda k: "plain words that follow each other number %d and so on." % k
    bad = lambda k: "BUY!! NOW!! %d $$$ ### @@@ | | |" % k
    return [(k, (good if k % 3 else bad)(k) * (1 + k % 5), "en", "a", 0) for k in range(rows)], [(k, int(k % 3 > 0), 0) for k in range(rows)]


def test_quality_on_held_out(spark, odd):
    docs, labels = labelled(600)
    scratch = Scratch(spark, "t")
    labels = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    table = spark.createDataFrame(docs, SCHEMA).repartition(6)
    found = quality.classify(table.unionByName(odd[1].select(table.columns).where("doc_id is null or doc_id > 1500")), labels, scratch).collect()
    truth = {i: int(i % 3 > 0) for i, *_ in docs}
    held = [r for r in found if r["doc_id"] in truth and r["held_out"]]
    assert len(held) > 50 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    kept = quality.keep_good(table, labels, Scratch(spark, "t"))
    assert kept.columns == table.columns
    assert np.mean([truth[r["doc_id"]] for r in kept.collect()]) > 0.97


def test_quality_equals_direct_solution(spark):
    """The summed normal equations give the ridge solution of all rows at once."""
    docs, labels = labelled(300)
    table = spark.createDataFrame(docs, SCHEMA).repartition(7)
    stats = quality.document_statistics(table.select("doc_id", "text"))
    model = quality.train(stats, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = {r["doc_id"]: r["stats"] for r in stats.collect()}
    fit = [k for k in rows if zlib.crc32(str(k).encode()) % 5 in (1, 2, 3)]
    x, y = np.array([rows[k] for k in fit]), np.array([float(k % 3 > 0) for k in fit])
    z = quality.fourier(x, model.mean, model.scale)
    direct = np.linalg.solve(z.T @ z + quality.PENALTY * len(fit) * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(z @ model.weights, z @ direct, atol=1e-6)


def test_isotonic():
    assert quality.isotonic(np.array([1, 3, 2, 4.0]), np.array([1, 1, 1, 1.0])).tolist() == [1, 2.5, 2.5, 4]
    assert quality.isotonic(np.array([3, 1.0]), np.array([1, 3.0])).tolist() == [1.5, 1.5]


def test_statistics_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["", "One two two\nOne two two\n", None, "!!", "  x  ", "a\n\n\nb", "É漢 é", "\n"]
    together = quality.statistics(pa.array(texts))
    for k, text in enumerate(texts):
        assert np.allclose(together[k], quality.statistics(pa.array([text]))[0])
    named = dict(zip(quality.STATISTICS, together[1]))
    assert named["repeated_words"] == pytest.approx(4 / 6) and named["repeated_lines"] == 0.5


def test_language_on_held_out(spark, odd):
    rng = random.Random(2)
    syllables = {"en": "the ing and ion th er ou".split(), "fr": "eau que ment oi é è le".split(), "de": "sch ein ung ä ß der pf".split()}
    rows = []
    for k in range(900):
        lang = ("en", "fr", "de")[k % 3]
        rows.append((k, " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(5, 40))), lang, "a", 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = langid.fit(docs, sample=300)
    found = langid.identify(docs.unionByName(odd[1].select(docs.columns)), model).withColumn("held", langid.fold() == 2).collect()
    held = [r for r in found if r["held"] and r["source"] == "a" and r["lang"] in syllables and r["doc_id"] >= 10]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != "und") == letters and 0 <= r["score"] <= 1


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scratch = Scratch(spark, "t")
    results = [
        exact_dedup.dedup(empty, scratch), exact_dedup.keep_first(empty, scratch), simhash.groups(empty, scratch), simhash.keep_one(empty, scratch),
        mixing.mix(empty, scratch), mixing.mixed(empty, scratch), bpe.tokenised(empty, VOCABULARY), secrets.digest(empty, scratch),
        quality.classify(empty, labels, scratch), quality.keep_good(empty, labels, scratch), langid.identify(empty, langid.fit(empty)),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_no_labels_keeps_everything(spark, odd):
    rows, table = odd
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(table, labels, Scratch(spark, "t")).count() == len(rows)
    assert {r["lang_pred"] for r in langid.identify(table, None).collect()} == {"und"}


def test_language_of_few_ids_with_many_rows(spark):
    """A language whose rows all repeat three ids is learned all the same."""
    english = [(k, f"the house and the garden of number {k}", "en") for k in range(300)]
    french = [(1001 + k % 9, "la maison et le jardin avec les fleurs", "fr") for k in range(20_000)]
    docs = spark.createDataFrame(english + french, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(docs, sample=60)
    assert model.langs == ["en", "fr"]
    asked = spark.createDataFrame([(1, "le jardin et la maison"), (2, "the garden and the house")], "doc_id long, text string")
    assert [r["lang_pred"] for r in langid.identify(asked, model).orderBy("doc_id").collect()] == ["fr", "en"]


def test_language_model_against_plain_code():
    """Features and probabilities of a text, one subword at a time."""
    texts = ["Été à Paris", "x", "", "the  cat\nsat"]
    bucket, owner = langid.subwords(texts)
    for k, text in enumerate(texts):
        words = [f" {w} " for w in "".join(c.lower() if c.isalpha() else " " for c in text).split()]
        wanted = []
        for size in langid.SIZES:
            for word in words:
                for at in range(len(word) - size + 1):
                    code = 0
                    for c in word[at:at + size]:
                        code = (code * 0x100000001B3 + ord(c)) % (1 << 64)
                    wanted.append(((code ^ size) * 0x9E3779B97F4A7C15) % (1 << 64) >> 48)
        assert sorted(bucket[owner == k].tolist()) == sorted(wanted)
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b", "c"], rng.normal(size=(langid.BUCKETS, 3)), rng.normal(size=3), 0.7, 0.0)
    for k, p in enumerate(model.probabilities(texts)):
        mine = bucket[owner == k]
        logits = (sum((model.table[b] for b in mine), np.zeros(3)) / max(len(mine), 1) + model.bias) / 0.7
        assert np.allclose(p, np.exp(logits) / np.exp(logits).sum())
    group = np.sort(rng.integers(0, 9, 50))
    rows = rng.normal(size=(50, 4))
    assert np.allclose(langid.sums_by(group, rows, 12), [rows[group == g].sum(axis=0) for g in range(12)])
