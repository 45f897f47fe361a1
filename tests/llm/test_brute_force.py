"""Mixing, the classifier's n-grams, the forest and the pipeline's stages against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_queries import ODD, write_tables
from tidemark.llm import mixing, neardup, quality, secrets
from tidemark.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def digest(*parts):
    text = "|".join("" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute_mix(rows, share=1.0, evenness=0.97, most_repeats=4.0, blocks=mixing.BLOCKS):
    """(doc_id, epoch, block, place) of each reading of (doc_id, text, source)."""
    docs = [(i, len(words(t)), s or "", digest(i, "block") % blocks, digest(i, "order")) for i, t, s in rows]
    cells, tokens = Counter(), Counter()
    for _, n, s, b, _ in docs:
        cells[s, b] += n
        tokens[s] += n
    total, known = sum(tokens.values()), sorted(s for s in tokens if tokens[s])

    def weights(a):
        powers = {s: (tokens[s] / total) ** a for s in known}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    def entropy(a):
        return -sum(w * math.log(w) for w in weights(a).values())

    def repeats(a):
        return share * max(w / (tokens[s] / total) for s, w in weights(a).items())

    def edge(fits, good, bad):
        for _ in range(100):
            good, bad = ((good + bad) / 2, bad) if fits((good + bad) / 2) else (good, (good + bad) / 2)
        return good

    a = 1.0
    if evenness is not None and entropy(1.0) < evenness * math.log(len(known)):
        a = edge(lambda x: entropy(x) >= evenness * math.log(len(known)), 0.0, 1.0)
    if most_repeats is not None and repeats(a) > most_repeats:
        a = edge(lambda x: repeats(x) <= most_repeats, 1.0, a)
    out = []
    for s in known:
        whole, rest = divmod(math.floor(round(weights(a)[s], 9) * share * total + 0.5), tokens[s])
        of = defaultdict(list)
        for i, n, source, b, h in docs:
            if source == s:
                of[b].append((h, i, n))
        for epoch in range(whole + 1):
            left = rest
            for place, b in enumerate(sorted(of, key=lambda b: (digest(s, b, epoch), b)), 1):
                if epoch < whole or 0 < cells[s, b] <= left or (cells[s, b] == 0 and left > 0):
                    out += [(i, epoch, b, place) for _, i, _ in of[b]]
                elif left > 0:
                    taken = Counter()
                    for h, _, n in of[b]:
                        taken[h] += n
                    upto, fit = 0, set()
                    for h in sorted(taken):
                        upto += taken[h]
                        if upto <= left:
                            fit.add(h)
                    out += [(i, epoch, b, place) for h, i, _ in of[b] if h in fit]
                left -= cells[s, b]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"share": 0.3, "evenness": 1.0, "blocks": 3}, {"share": 2.5, "evenness": None, "most_repeats": None, "blocks": 7}, {"evenness": 1.0, "most_repeats": 1.5, "blocks": 2}])
def test_mix_equals_brute_force(spark, documents, options):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    rows += [(None, "no id here", "a"), (7001, None, "none"), (7002, "of no source", None), (7003, "twice", "a"), (7003, "twice", "a")]
    named = {"budget_share" if k == "share" else k: v for k, v in options.items()}
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(table, **named).select("doc_id", "epoch", "block", "place").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_mix(rows, **options)


def brute_ngrams(text):
    ws, cs = words(text), re.sub("[ \t-\r]", " ", text)
    found = Counter(("w", w) for w in ws)
    found.update(("p", "same" if a == b else (a, b)) for a, b in zip(ws, ws[1:]))
    for n in (3, 4):
        found.update(("c", cs[i : i + n]) for i in range(len(cs) - n + 1) if " " not in cs[i + 1 : i + n - 1])
    return found


def test_ngrams_of_the_classifier_equal_brute_force():
    texts = ["", "a", "a b c", "the cat  the\tcat sat", "é漢 x\ny é漢", "aaaa aaaa aaaa", "the cat sat on", " "]
    data = [t.encode() for t in texts]
    row, found = quality.ngrams(b"".join(data), np.cumsum([0, *map(len, data)]), 1 << 40)
    got, want = [Counter(found[row == i].tolist()) for i in range(len(texts))], [brute_ngrams(t) for t in texts]
    assert [sorted(g.values()) for g in got] == [sorted(w.values()) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(got[i].keys() & got[j].keys()) == len(want[i].keys() & want[j].keys())


def test_scores_are_the_mean_of_the_ngrams_weights(spark):
    texts = ["", "one two three", "x " * 50, "é漢 x"]
    model = quality.Model(np.random.default_rng(3).normal(size=64).astype(np.float32), 0.25)
    rows = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, Score string")
    scored = quality.score(rows, model)
    assert scored.columns == ["doc_id", "text", "score"]
    for r in scored.collect():
        data = r["text"].encode()
        _, found = quality.ngrams(data, np.array([0, len(data)]), 64)
        mean = sum(float(model.weights[b]) for b in found) / max(1, len(found))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-mean - 0.25)), abs=1e-9)


def test_a_score_equal_to_the_threshold_is_predicted(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("false")
    out = quality.quality_scores(documents, labels, threshold=0.5)
    assert out.filter("score = 0.5 and predicted = 1").count() == documents.count()


def walk(node, values):
    while not isinstance(node, float):
        at, limit, left, right = node
        node = left if values[at] <= limit else right
    return node


@pytest.fixture(scope="module")
def judged(spark):
    """Three quarters of the labelled findings of a corpus fit a forest, which judges the rest."""
    rows = secrets.findings(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    held = F.pmod(F.xxhash64("found", "before", "after"), F.lit(4)) == 1
    trees = secrets.forest(rows.filter(~held))
    values = secrets.features(F.col("found"), F.col("before"), F.col("after"))
    return trees, rows.filter(held).select("label", values.alias("f"), secrets.chance(trees, values).alias("p")).collect()


def test_forest_as_an_expression_equals_its_trees(judged):
    trees, rows = judged
    for r in rows:
        assert r["p"] == pytest.approx(sum(walk(t, r["f"]) for t in trees) / len(trees), abs=1e-12)


def test_forest_on_held_out_findings(judged):
    _, rows = judged
    seen = Counter((r["label"], r["p"] >= 0.5) for r in rows)
    assert seen[1, True] + seen[1, False] > 100 and seen[0, True] + seen[0, False] > 100
    assert seen[1, True] >= 0.95 * (seen[1, True] + seen[1, False])
    assert seen[1, True] >= 0.95 * (seen[1, True] + seen[0, True])


def test_candidates_lie_where_they_are_said_to(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = secrets.scan(documents).collect()
    assert found
    for r in found:
        assert texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == r["found"]


def test_stages_of_the_pipeline(spark, documents):
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda rows: sorted(r["doc_id"] for r in rows.select("doc_id").collect())
    good = stage["quality classifier"](spark, documents, SF)
    scored = quality.quality_scores(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(good) == ids(scored.filter("predicted = 1")) and good.columns == corpus_pipeline.COLUMNS
    first = {}
    for r in neardup.classes(documents).collect():
        first[r["class_id"]] = min(first.get(r["class_id"], r["doc_id"]), r["doc_id"])
    assert ids(stage["near duplicates"](spark, documents, SF)) == sorted(first.values())
    link = duckdb.connect()
    for table in ("documents", "benchmark"):
        link.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    clean = link.execute(f"select doc_id from ({ORACLE['op3_decontamination']}) where not contaminated order by 1").fetchall()
    assert ids(stage["benchmark decontamination"](spark, documents, SF)) == [i for (i,) in clean]
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in secrets.scan(documents).filter("is_secret").orderBy("doc_id", F.desc("start")).collect():
        at = r["start"]
        texts[r["doc_id"]] = texts[r["doc_id"]][:at] + secrets.REPLACEMENT + texts[r["doc_id"]][at + r["length"] :]
    redacted = stage["secret scan"](spark, documents, SF).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in redacted} == {i: (t, len(t)) for i, t in texts.items()}
    mixed = stage["mixing"](spark, documents, SF).select("doc_id", "epoch", "block", "place").collect()
    assert sorted((tuple(r) for r in mixed), key=repr) == brute_mix([(r["doc_id"], r["text"], r["source"]) for r in documents.collect()])


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    odd, empty = write_tables(spark, str(tmp_path / "odd"), ODD), write_tables(spark, str(tmp_path / "empty"), [])
    out = corpus_pipeline.run(spark, odd)
    columns = [*corpus_pipeline.COLUMNS, "n_tokens", "epoch", "block", "place"]
    assert out.columns == columns and corpus_pipeline.run(spark, empty).columns == columns
    assert corpus_pipeline.run(spark, empty).isEmpty()
    assert {r["doc_id"] for r in out.collect()} <= {i for i, *_ in ODD}
