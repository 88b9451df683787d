"""Operators with a trained or iterative part: accuracy on held-out rows, balance of the result, edge cases."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import awkward, empty, no_labels, shared, shared_labels  # noqa: F401

import corpus_pipeline
from martwright.llm.licenses import TEMPLATES, LicenseScan, license_passages
from martwright.llm.mixing import DOMAINS, Rates, fit_classifier, fit_rates, mix_sources, take_share
from martwright.llm.secrets import FEATURES, secret_scan


def folded(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", low)


def passages(text):
    own = {tuple(folded(text)[i : i + 5]) for i in range(len(folded(text)) - 4)}
    out = set()
    for name, template in TEMPLATES.items():
        words = folded(template)
        wanted = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        if len(wanted & own) >= 0.8 * len(wanted):
            out.add(name)
    return out


def test_licenses_against_whole_shingle_sets(spark, shared, awkward, empty):
    noise = "alpha beta gamma delta epsilon " * 30
    made = [
        (10**6, noise + TEMPLATES["MIT"].upper().replace("MERGE", "FUSE") + " end " + noise),
        (10**6 + 1, TEMPLATES["Apache-2.0"][:60]),
        (10**6 + 2, " ".join(TEMPLATES.values())),
    ]
    df = shared.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    found = license_passages(df).collect()
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    want = {(i, name) for i, t in texts.items() for name in passages(t)}
    assert {(r["doc_id"], r["license"]) for r in found} == want and len(want) > 8
    for r in found:
        part = " ".join(folded(texts[r["doc_id"]])[r["first_word"] : r["last_word"] + 1])
        assert r["license"] in passages(part) and r["containment"] >= 0.8
    assert license_passages(empty).count() == 0
    license_passages(awkward, LicenseScan(templates=(("short", "one two"),))).collect()


def test_rates_reach_their_targets(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    data = [(int(n), [float(x) for x in row]) for n, row in zip(rng.integers(1, 500, 400), p, strict=True)]
    scored = spark.createDataFrame(data, "__n long, __p array<double>").cache()
    targets = [1.3, 0.6, 0.2]
    rates = fit_rates(scored, targets)
    found = scored.withColumn("rate", rates.rate(F.col("__p"))).toPandas()
    assert (found.rate >= 0).all() and (found.rate == 0).any()
    n, post = found["__n"].to_numpy(), np.stack(found["__p"])
    now = (found.rate.to_numpy() * n) @ post / (n @ post)
    assert now == pytest.approx(targets, abs=0.02)
    # The same steps in plain numbers.
    rate = np.ones(len(n))
    for errors in rates.steps:
        rate = np.maximum(0, rate - post @ np.array(errors) - rates.pull * (rate - 1))
    assert found.rate.to_numpy() == pytest.approx(rate)
    assert fit_rates(scored.limit(0), targets).steps == [] or Rates().steps == []
    scored.unpersist()


def test_classifier_on_held_out_labels(spark, shared, shared_labels):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    fitted = fit_classifier(docs, labels.where("doc_id % 4 <> 0"))
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    told = fitted.posteriors(docs.join(labels.where("doc_id % 4 = 0"), "doc_id"))
    best = F.array_position("__p", F.array_max("__p")) - 1
    right = told.select((best == domain).cast("int").alias("right"), domain.alias("domain")).toPandas()
    assert right.right.mean() > 0.85 and right[right.domain == 0].right.mean() > 0.93


def test_mixing_of_awkward_rows(spark, awkward, empty, no_labels):
    weights = {"clean": 0.9, "junk": 0.08, "toxic": 0.02}
    some = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (7, 1, 1), (None, 1, 1), (6, None, 0)], no_labels.schema)
    for labels in (no_labels, some):
        found = mix_sources(awkward, labels, weights).collect()
        assert len(found) == awkward.count()
        assert all(r["rate"] >= 0 and sum(r[f"p_{d}"] for d in DOMAINS) == pytest.approx(1) for r in found)
        assert {r["doc_id"]: r["n_tokens"] for r in found}[3] == 0
    kept = take_share(awkward, no_labels, corpus_pipeline.MULTIPLES)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert mix_sources(empty, some, weights).count() == 0
    assert take_share(empty, some, corpus_pipeline.MULTIPLES).count() == 0


def test_secrets(spark, shared, awkward, empty):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = secret_scan(docs).collect()
    for r in found:
        text = texts[r["doc_id"]]
        assert text[r["start"] : r["end"]] == r["secret"]
        assert r["is_secret"] == bool(re.search(r'token = "$', text[: r["start"]]))
    runs = sum(len(re.findall("[A-Za-z0-9+/=_-]{16,}", t)) for t in texts.values())
    assert len(found) == runs
    secret_scan(awkward).collect()
    secret_scan(awkward, path_column=None).collect()
    assert secret_scan(empty).count() == 0


def test_forest_learns_from_given_findings(spark):
    """Held-out findings: secrets are mixed runs behind a name, false positives look alike but are in prose."""
    rng = np.random.default_rng(6)
    digits = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    train = []
    for i in range(300):
        train.append((digits(40), 'api_key = "', '" x', "src/main.py", 1))
        train.append((digits(40), "commit ", " fixed it", "docs/changes", 0))
        train.append(("counterrevolutionary", "the ", " words", f"p{i}", 0))
    labelled = spark.createDataFrame(train, "match string, before string, after string, path string, label int")
    labelled = labelled.withColumn("label", F.col("label").cast("double"))
    docs = spark.createDataFrame(
        [(i, f'password = "{digits(40)}" and commit {digits(40)} was fine') for i in range(20)],
        "doc_id long, text string",
    )
    found = secret_scan(docs, labelled, path_column=None).orderBy("doc_id", "start").collect()
    assert [r["is_secret"] for r in found] == [True, False] * 20
    assert len(FEATURES) == 15


def test_pipeline_stages(spark, shared, shared_labels):
    folder = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES][:3] == ["quality rules", "MinHash near-dedup", "PII"]
    docs, counts = shared, [shared.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, docs, folder), "test")
        assert kept.columns == shared.columns and kept.schema == docs.schema
        counts.append(kept.count())
        docs = kept
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0]
    label = {r["doc_id"]: (r["quality"], r["toxic"]) for r in shared_labels.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    ids = {r["doc_id"] for r in packed.collect()}
    assert not [i for i in ids if label.get(i, (1, 0))[0] == 0]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == ids


def test_pipeline_of_an_empty_table(spark, empty, tmp_path, no_labels):
    no_labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0
