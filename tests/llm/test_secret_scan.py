"""The secret scan's patterns against the contract's words, its field against brute force and held-out secrets, and odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from conftest import SMALL, TESTDATA

from basketmill.llm import queries, secret_scan


def documents(folder=SMALL):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def base_by_hand(text):
    """The patterns as they are written, and failing matches dropped."""
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", *m.span()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda span: (span[1], ("assign", "access", "hex").index(span[0])))


def written(spans):
    return ",".join(":".join(map(str, span)) for span in spans)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    texts = [text or "" for _, text in documents(f"{TESTDATA}/sf0.01")]
    starts = [rng.randint(0, max(0, len(text) - 400)) for text in texts]
    return secret_scan.train([text[start : start + 400] for text, start in zip(texts, starts, strict=True)])


BORDERS = [
    "token=abcde", "token=abcdef", "TOKEN: abcdef.", "api_key='abcdef'", "apikey=\"abcdef\"", "secret=token:abcdef", "password  =  x1x2x3==",
    "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIA" + "0" * 30 + "AKIA" + "1" * 16, "AKIAAKIA" + "Z" * 12,
    "f" * 23, "f" * 24, "F" * 24, "ab" * 12 + "g" + "0" * 24, "é token=äbcdef secret=abcdefg", "toKen=abcdef", "ſecret=abcdef",
    "token=" + "a" * 40 + " passwd:" + "0" * 30 + "AKIA" + "B" * 20,
]


def test_patterns():
    for text in [*BORDERS, " ".join(BORDERS), "\n".join(BORDERS), *(text or "" for _, text in documents())]:
        found = sorted(secret_scan.base_spans(text), key=lambda span: (span[1], span[0]))
        assert [(secret_scan.KINDS[kind], start, end) for kind, start, end in found] == base_by_hand(text)


def test_query(spark):
    found = {row["doc_id"]: row for row in queries.op12_secrets(spark, SMALL).collect()}
    docs = documents()
    assert len(found) == len(docs)
    for doc_id, text in docs:
        row, base = found[doc_id], base_by_hand(text or "")
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(one[0] == kind for one in base) for kind in ("assign", "access", "hex")]
        assert row["base_sha256"] == hashlib.sha256(written(base).encode()).hexdigest()
        spans = [tuple(one.split(":")) for one in row["spans"].split(",")] if row["spans"] else []
        assert written(one for one in spans if one[0] != "crf") == written(base)
        order = [(int(start), secret_scan.KINDS.index(kind)) for kind, start, _ in spans]
        assert order == sorted(order)


def test_odd_rows(spark, model):
    secret = "the key is ghp_0123456789abcdefABCDEFghijklmnopqrst and token=abcdef1"
    rows = [(1, secret, "x", 3), (1, secret, "x", 3), (2, None, None, None), (3, "", "", 0), (None, secret, "", 0), (4, " \n\t ", "", 0)]
    long = "plain words, all of them! " * 60_000 + secret
    table = spark.createDataFrame([*rows, (5, long, "", 0)], "doc_id long, text string, spans string, start int")
    found = secret_scan.find_secrets(table, model=model)
    got = sorted(found.collect(), key=str)
    assert len(got) == 7 and found.columns == ["doc_id", "spans"]
    for row in got:
        text = long if row["doc_id"] == 5 else secret if row["doc_id"] in (1, None) else ""
        kinds = [(one["kind"], one["value"]) for one in row["spans"]]
        assert all(text[one["start"] : one["end"]] == one["value"] for one in row["spans"])
        expected = [("crf", "ghp_0123456789abcdefABCDEFghijklmnopqrst"), ("assign", "token=abcdef1")] if text else []
        assert kinds == expected
    assert secret_scan.find_secrets(table.limit(0), model=model).count() == 0
    assert secret_scan.find_secrets(table.limit(0)).count() == 0  # trained on generated passages alone
    empty = secret_scan.span_digests(found.filter("doc_id = 3")).first()
    assert tuple(empty) == (3, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")


def test_held_out_secrets_and_plain_text(model):
    rng, weights = random.Random(77), secret_scan.Weights(model)
    texts = [text or "" for _, text in documents(f"{TESTDATA}/sf0.01")]
    hits = 0
    for _ in range(300):
        before, secret, after = secret_scan.made_secret(rng)
        around = rng.choice(texts)[:200]
        start = len(around) + 1 + len(before)
        spans = secret_scan.field_spans(f"{around}\n{before}{secret}{after} {around}", weights)
        hits += any(one < start + len(secret) and start < end for one, end in spans)
    assert hits >= 285
    # What is no secret by the patterns is hardly ever one here: the texts hold none of another form.
    assert sum(any(kind == 3 for kind, _, _ in secret_scan.all_spans(text, weights)) for text in texts) <= 0.01 * len(texts)


def path_score(found, follows, tags):
    before = [secret_scan.OUTSIDE, *tags[:-1]]
    return sum(follows[a, b] + ([0.0, *row])[b] for a, b, row in zip(before, tags, found, strict=True))


def test_decoding_equals_all_paths():
    """Viterbi between tokens that are surely outside gives the best of all paths, at the text's end too."""
    rng = np.random.default_rng(2)
    for trial in range(300):
        model = secret_scan.Field({}, ({}, {}, {}), {}, rng.normal(size=(3, 3)) * 2)
        found = rng.normal(size=(rng.integers(1, 8), 2)) * 3 - rng.integers(0, 6)
        paths = itertools.product(range(3), repeat=len(found))
        best = max(path_score(found, model.follows, path) for path in paths)
        tags = secret_scan.tag(found, model)
        assert path_score(found, model.follows, [tags.get(at, 0) for at in range(len(found))]) == pytest.approx(best), trial


def test_decoding_equals_the_whole_texts(model):
    weights = secret_scan.Weights(model)
    for _, text in documents():
        found = secret_scan.scores(text or "", weights)
        assert np.array_equal(found, secret_scan.scores(text or "", weights, size=40))
        if len(found):
            whole = {at: one for at, one in enumerate(secret_scan.viterbi(found, model.follows, last=True)) if one}
            assert whole == secret_scan.tag(found, model)
            assert secret_scan.field_spans(text, weights, size=40) == secret_scan.field_spans(text, weights)


def test_likelihood_equals_all_paths_and_its_gradient():
    passages = [secret_scan.passage("key = a1b2C3 end", [(6, 12)]), secret_scan.passage("x 9", [])]
    trainer = secret_scan.Trainer(passages)
    theta = np.random.default_rng(4).normal(size=sum(a * b for a, b in trainer.shapes)) * 0.5
    loss, gradient = trainer.loss(theta)
    emitted, follows = trainer.emissions(theta), trainer.split(theta)[-1]
    expected = 0.0
    for row, one in zip(emitted, passages, strict=True):
        relative = row[: len(one.tokens)]

        def worth(tags, relative=relative):
            return sum(follows[a, b] + scores[b] for a, b, scores in zip([0, *tags[:-1]], tags, relative, strict=True))

        total = np.logaddexp.reduce([worth(tags) for tags in itertools.product(range(3), repeat=len(relative))])
        expected += total - worth(one.tags)
    tokens = sum(len(one.tokens) for one in passages)
    assert loss == pytest.approx(expected / tokens + secret_scan.RIDGE / 2 * theta @ theta)
    for at in range(0, len(theta), 5):
        step = np.zeros_like(theta)
        step[at] = 1e-6
        assert gradient[at] == pytest.approx((trainer.loss(theta + step)[0] - trainer.loss(theta - step)[0]) / 2e-6, abs=1e-7)
