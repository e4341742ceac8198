"""Operators that compare documents, against brute force on small tables."""

import collections
import hashlib
import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from shopcast.llm import backoff, catalog, common, decontaminate, minhash, mixing, suffixes, toxicity, urls

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def documents(spark, sf=SMALL):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200)] + [(5, 4)]
    got = {r.node: r.comp for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(words, at):
    return " ".join("changed" + str(k) if k in at else w for k, w in enumerate(words))


def test_minhash_equals_brute_force(spark):
    rows = documents(spark)
    base = [f"word{k}" for k in range(160)]
    copies = [(1000 + i, edited(base, {(7 * i + 19 * k) % 160 for k in range(i % 9)})) for i in range(60)]
    short = [(2000, "One two"), (2001, "one TWO"), (2002, "one two three"), (2003, ""), (2004, None), (2005, " ")]
    rows += copies + short
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_minhash_nulls_and_repeats(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (1, "A B c d e f"), (3, "other words"),
            (4, "other words")]
    source = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit(1)).withColumn("comp", F.lit("x"))
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_duplicates(source).collect())
    assert got == [("1", 1, True), ("3", 1, False), ("3", 1, False), ("3", 1, False), ("4", 1, False),
                   ("None", None, True)]
    assert sorted(str(r.doc_id) for r in minhash.keep_one(source).collect()) == ["1", "None"]
    assert minhash.near_duplicates(source.limit(0)).count() == 0


def brute_repeats(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if seen[d[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(d, gone) if not g)
        n = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(d), sum(gone), n, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("width,hot", [(400, 4096), (100, 4096), (100, 2)])
def test_suffixes_equal_brute_force(spark, width, hot):
    rows = documents(spark)
    rows += [(None, "x" * 1000), (None, rows[3][1]), (7, None), (7, ""), (8, "ab" * 500), (8, "ab" * 500), rows[5]]
    source = spark.createDataFrame(rows, SCHEMA).withColumn("marks", F.lit(1)).repartition(5)
    got = collections.Counter(map(tuple, suffixes.digest(source, width, hot).collect()))
    want = brute_repeats([t for _, t in rows], width)
    assert got == collections.Counter((i, *w) for (i, _), w in zip(rows, want))


def test_suffixes_of_a_text_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 5000)
    monkeypatch.setattr(suffixes, "groups", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    import numpy as np
    text = "".join(f"{k * 7919 % 10007} " for k in range(4000))
    data = np.frombuffer(text.encode(), np.uint8)
    starts = set()
    for _, cuts, before in suffixes._pieces(np.array([0, len(data)]), 400):
        _, lo, hi, *_ = suffixes.spans(data[cuts[0]:cuts[-1]], cuts - cuts[0], 400)
        for a, b in zip(lo + before, hi + before):
            assert starts.isdisjoint(range(a, b + 1))
            starts.update(range(a, b + 1))
    assert starts == set(range(len(data) - 399))


def test_backoff_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(backoff, "GROUP_BYTES", 60_000)
    monkeypatch.setattr(backoff, "BUCKET_BYTES", 30_000)
    rows = documents(spark) + [(500, None), (501, ""), (502, "only")]
    words = {i: WORD.findall(t or "") for i, t in rows}
    for order in (2, 3):
        counts = collections.Counter(tuple(w[i:i + k]) for w in words.values() for k in range(1, order + 1)
                                     for i in range(len(w) - k + 1))
        n = sum(map(len, words.values()))
        for r in backoff.backoff_scores(spark.createDataFrame(rows, SCHEMA), order=order).collect():
            w, total = words[r.doc_id], 0.0
            for p in range(len(w)):
                k = min(p, order - 1)
                while k and counts[tuple(w[p - k:p + 1])] < 2:
                    total, k = total + math.log(0.4), k - 1
                total += math.log(counts[tuple(w[p - k:p + 1])] / (counts[tuple(w[p - k:p])] if k else n))
            assert r.n_tokens == len(w) and r.log_score == pytest.approx(total, abs=1e-6)
    assert backoff.backoff_scores(spark.createDataFrame([], SCHEMA)).count() == 0


def test_decontamination_finds_passages(spark):
    got = {r.doc_id: set(r.item_ids) for r in catalog.op1_decontaminate(spark, MID).collect()}
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = {r.item_id: split(r.text) for r in spark.read.parquet(f"{MID}/benchmark.parquet").collect()}
    grams = {}
    for i, w in items.items():
        for k in range(len(w) - 12):
            grams.setdefault(tuple(w[k:k + 13]), set()).add(i)
    rows = documents(spark, MID)
    assert len(got) == len(rows)
    for i, t in rows:
        w = split(t)
        assert set().union(*(grams.get(tuple(w[k:k + 13]), set()) for k in range(len(w)))) <= got[i]
    assert 0 < sum(map(bool, got.values())) < 60


def test_decontamination_tolerates_substitutions(spark):
    item = [f"item{k}" for k in range(30)]
    filler = " ".join(f"filler{k}" for k in range(50))
    rows = [(1, f"{filler} {' '.join(item)} {filler}"), (2, f"{filler} {edited(item, {5, 14, 23})}"),
            (3, f"{filler} {' '.join(item[:6])} {filler}"), (4, None), (None, " ".join(item).upper()), (4, ""),
            (5, edited(item, set(range(0, 30, 2))))]
    bench = spark.createDataFrame([(9, " ".join(item)), (10, None), (11, "too short"), (None, filler)],
                                  "item_id long, text string")
    source = spark.createDataFrame(rows, SCHEMA).withColumn("item_id", F.lit(0)).withColumn("hid", F.lit(0))
    got = sorted((str(r.doc_id), r.contaminated, r.item_ids) for r in decontaminate.contamination(source, bench).collect())
    assert got == [("1", True, [9]), ("2", True, [9]), ("3", False, []), ("4", False, []), ("4", False, []),
                   ("5", False, []), ("None", True, [9])]
    assert sorted(str(r.doc_id) for r in decontaminate.clean_only(source, bench).collect()) == ["3", "4", "4", "5"]
    assert decontaminate.contamination(source, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(source.limit(0), bench).count() == 0


def test_masks_cover_every_overlap_of_the_rule(spark):
    rule, items, rows = decontaminate.Seeds(), [], []
    for span in range(1, 14):
        assert not decontaminate.uncovered(rule.masks_for(span), span, rule.allowed(span))
        item = [f"n{span}w{k}" for k in range(span)]
        items.append((span, " ".join(item)))
        rows += [(1000 * span + n, f"left {edited(item, set(p))} right")
                 for n, p in enumerate(itertools.combinations(range(span), rule.allowed(span)))]
        rows.append((-span, f"left {edited(item, set(range(rule.allowed(span) + 1)))} right"))
    got = decontaminate.contamination(spark.createDataFrame(rows, SCHEMA),
                                      spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(rows)
    assert all(r.item_ids == ([r.doc_id // 1000] if r.doc_id > 0 else []) for r in got)
    with pytest.raises(ValueError):
        decontaminate.Seeds(masks=("11011011", "1100101011"))


def test_seed_join_without_broadcast(spark, monkeypatch):
    want = sorted(map(tuple, catalog.op1_decontaminate(spark, SMALL).select("doc_id", "n_items").collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert sorted(map(tuple, catalog.op1_decontaminate(spark, SMALL).select("doc_id", "n_items").collect())) == want


def test_mixing_meets_weights_and_limits(spark):
    rows = [(i, "w " * (1 + i % 40), "big") for i in range(3000)] + [(5000 + i, "w " * 20, "small") for i in range(60)]
    rows += [(9000, "x y", None), (9001, None, "empty")]
    source = spark.createDataFrame(rows, SCHEMA + ", source string").withColumn("block", F.lit("b"))
    mix = mixing.Mix(entropy=1.0, epochs=3.0, budget=50_000)
    got = mixing.draws(source, mix).collect()
    tokens, share = collections.Counter(), {}
    for r in got:
        tokens[r.source] += r.n_tokens
        share[r.source] = r.weight
    total = {"big": sum(1 + i % 40 for i in range(3000)), "small": 1200, None: 2}
    assert max(share[s] * 50_000 / total[s] for s in share) == pytest.approx(3.0, rel=1e-6)
    for s, w in share.items():
        assert abs(tokens[s] - w * 50_000) <= 40
    assert "empty" not in share
    epochs = collections.Counter((r.doc_id, r.epoch) for r in got)
    assert set(epochs.values()) == {1}
    assert {r.doc_id for r in got if r.source == "small" and r.epoch == 0} == set(range(5000, 5060))
    assert mixing.draws(source.limit(0)).count() == 0


def test_mixing_entropy_target(spark):
    sources = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, tokens long")
    a = mixing.exponent(sources, mixing.Mix(entropy=0.8, epochs=1e9), 1110.0)
    w = [(n / 1110) ** a for n in (1000, 100, 10)]
    q = [x / sum(w) for x in w]
    assert -sum(x * math.log(x) for x in q) == pytest.approx(0.8 * math.log(3), abs=1e-6)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    rows = catalog.op9_toxicity(spark, MID).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    clean = [r for r in held if labels[r.doc_id] == 0]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_toxicity_grammar_and_learned_stems(spark):
    g = toxicity.Grammar(frozenset({"blor"}))
    assert g.matches("You are an idiot.") == [0, 1, 0, 0, 0]
    assert g.matches("He is not an idiot") == [0, 0, 1, 0, 0]
    assert g.matches("She said: that idiot! They said what an idiot") == [1, 0, 0, 1, 0]
    assert g.matches("I will kill you. kill the lights") == [0, 0, 0, 0, 1]
    assert g.matches("blorfex und blorum") == [2, 0, 0, 0, 0]
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"left{letters[i % 26]} blor{letters[i % 7]} some words {i}", 1) for i in range(60)]
    rows += [(100 + i, f"plain words here {i}", 0) for i in range(200)]
    source = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (900, "")], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (101, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(source, labels).collect()}
    assert all(got[i].predicted == y for i, _, y in rows) and got[None].predicted == got[900].predicted == 0
    assert toxicity.toxicity(source, labels.limit(0)).count() == len(rows) + 2
    assert toxicity.toxicity(source.limit(0), labels).count() == 0


def test_url_rules(spark):
    rows = [(1, "HTTP://Www.Example.NET/en/1?x=/y"), (2, "http://a.net/"), (3, "http://a.net"), (4, None), (5, "nothing"),
            (6, "x://example.com/de/#f"), (7, "x://notexample.com/de/"), (8, "x://b.org/fr/a"), (None, "x://b.org/en/a"),
            (8, "x://b.org/fr/a")]
    source = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1))
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.url_verdicts(source).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "www.example.net", "/en/1", "example.net/en/", "allow"), (2, "a.net", "/", "net/", "block"),
        (3, "a.net", "", None, "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "example.com", "/de/", "example.com/de/", "block"), (7, "notexample.com", "/de/", None, "allow"),
        (8, "b.org", "/fr/a", "org/fr/", "allow"), (8, "b.org", "/fr/a", "org/fr/", "allow"),
        (None, "b.org", "/en/a", None, "allow")], key=str)
    assert urls.url_verdicts(source.limit(0)).count() == 0


def test_url_templates_learn_from_labels(spark):
    rows = [(i, f"http://h.com/shop/item-{i}x/{'buy' if i % 2 else 'see'}") for i in range(200)]
    rows += [(1000 + i, f"http://h.com/news/{i}") for i in range(200)]
    labels = spark.createDataFrame([(u, int("shop" in u)) for i, u in rows if i % 3], "url string, bad int")
    got = urls.url_verdicts(spark.createDataFrame(rows, "page_id long, url string"), labels=labels).collect()
    assert all(r.verdict == ("block" if "/shop/" in r.path else "allow") for r in got)
    assert {r.template for r in got if "/news/" in r.path} == {"/news/*"}


def test_url_branches_of_bad_hosts(spark):
    paths = [f"en/a{i}" for i in range(30)] + ["de/x", "fr/y", "fr/z", ""]
    bad = [f"http://www.casino-win.com/{x}" for x in paths] + ["http://payday.top/", "http://a.spam.info:80/only/one"]
    given = [f"http://quiet.com/b{i}/{x}" for i in range(10) for x in "cd"] + ["http://quiet.com/alone"]
    clean = [f"http://{h}/{x}" for h in ("alphabets.com", "casinoville-museum.com", "sussexxx.uk") for x in paths]
    good = [f"http://fine.com/{x}" for x in paths]
    source = spark.createDataFrame(list(enumerate(bad + given + clean + good)), "page_id long, url string")
    labels = spark.createDataFrame([(u, 1) for u in given] + [(u, 0) for u in good], "url string, bad int")
    got = urls.url_verdicts(source, labels=labels).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(len(bad + given)))
    assert {r.template for r in got if r.host == "quiet.com"} <= {"/*", "/*/c", "/*/d", "/*/*"}


def test_pipeline_stages_equal_brute_force(spark):
    import corpus_pipeline as cp
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in cp.STAGES][-1] == "mixing" and len(cp.STAGES) == 5
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        out = common.table(stage(spark, docs, SMALL), f"t{k}")
        assert out.columns == columns
        if name == "near-duplicates":
            kept = brute_components([(r.doc_id, r.text) for r in docs.collect()])
            assert {r.doc_id for r in out.collect()} == {i for i, (_, c) in kept.items() if i == c}
        if name == "secret scan":
            assert out.count() == docs.count() and out.filter(F.col("text").rlike("[0-9a-f]{24}")).count() == 0
            assert out.filter("n_chars <> length(text)").count() == 0
        docs = out
    mixed = cp.run(spark, SMALL)
    assert {r.doc_id for r in mixed.filter("epoch = 0").collect()} <= {r.doc_id for r in docs.collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert docs.join(labels, "doc_id").filter("quality = 0").count() == 0
