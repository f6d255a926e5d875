"""Toxicity, language model, quality, secrets and pieces."""

import base64
import collections
import json
import math
import os
import random
import zlib

import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from campusweave.llm import brown_lm, quality, queries, secrets, sentencepiece, toxicity
from tests.llm.conftest import prose

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
DATA = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
ODD = ["", None, " \n\t", "x" * 200_000, "é漢🙂▁ a\x00b"]


def test_grammar_composes():
    g = toxicity.Grammar({"fool": 3.0, "rott*": 2.0})
    clause = lambda s: g.clause(s.split())
    assert clause("a fool") == 3.0 and clause("a rottweil fool") == 5.0
    assert clause("not a fool") == 3.0 * toxicity.NEGATED
    assert clause("he said fool") < clause("he is fool") == 3.0 * toxicity.TARGETED
    assert clause("i kill you") == toxicity.THREAT * toxicity.TARGETED and clause("i kill time") == 0 == clause("never kill you")
    assert g.features("")[0] == 0 and g.score("plain words") < g.score("you fool")


def test_toxicity_learns_and_holds_out(spark, docs):
    rng = random.Random(0)
    rows = [(i, prose(30, i) + (f" {rng.choice(['zzkor', 'zzkora', 'brabbel'])} " * 2 if i % 5 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(7, None), (99999, 1)], "doc_id long, toxic int")
    table = docs(*rows, (1000, ""), (1001, None), (1001, "x" * 100_000))
    g = toxicity.learn(table, labels)
    out = toxicity.scored(table, g).collect()
    assert len(out) == 603 and all(0 <= r["score"] <= 1 for r in out)
    rest = {r["doc_id"]: r["score"] >= 0.7 for r in out if 400 <= r["doc_id"] < 600}
    assert rest == {i: i % 5 == 0 for i in range(400, 600)}


def test_toxicity_without_labels(spark, docs):
    g = toxicity.learn(docs("a"), spark.createDataFrame([], "doc_id long, toxic int"))
    out = {r["doc_id"]: r["score"] for r in toxicity.scored(docs("you idiot moron", "good day", *ODD), g).collect()}
    assert out[0] > 0.5 > out[1] and len(out) == 7
    assert toxicity.scored(docs().limit(0), g).collect() == []


@DATA
def test_op1(spark):
    sf = os.path.join(os.path.dirname(SF), "sf0.01")
    rows = queries.QUERIES["op1_toxicity"](spark, sf).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    # ties count half; a few hundred labelled texts give most languages' stems only in part
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) > 0.85 * len(toxic) * len(clean)


def counted(rows):
    c = collections.Counter()
    for t in rows:
        c.update((t or "").encode().lower().split() + [None])
    return c


def test_language_model_counts(spark, docs):
    train = [prose(40, i, 50) for i in range(60)] + ["", None, "rare once"]
    model, table = brown_lm.learn(docs(*train), classes=4, share=30, clustered=10)
    c = counted(train)
    n, v = sum(c.values()), len(c)
    score = [*train[:3], "w1 unseen w2", "UNSEEN w1", *ODD]
    for r, t in zip(sorted(brown_lm.scored(docs(*score), model, table).collect(), key=lambda r: r["doc_id"]), score, strict=True):
        w = (t or "").encode().lower().split() + [None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / len(w)))


def test_language_model_is_a_distribution(spark, docs):
    """From each word, the probabilities of all known words, the end and one unknown word add up to 1."""
    train = [prose(30, i, 12) for i in range(40)]
    model, table = brown_lm.learn(docs(*train), classes=3, share=8, clustered=5)
    vocabulary = [x.decode() for x in counted(train) if x] + ["unknown"]
    score = lambda rows: {r["doc_id"]: r["score"] for r in brown_lm.scored(docs(*rows), model, table).collect()}
    # P(w v end) / P(w end) * P(end | w) ... summed over v: the chain from w through v to the end, freed of the last step
    pairs = score([f"w1 {v}" for v in vocabulary] + ["w1"])
    ends = score(vocabulary + [""])
    start = pairs[len(vocabulary)]
    alone = {i: ends[i] for i in range(len(vocabulary))}
    first = score(["w1"])[0]
    assert start == first and all(x < 0 for x in alone.values())
    one = sum(10**x for x in alone.values())
    assert 0 < one + 10 ** ends[len(vocabulary)] <= 1 + 1e-9


def test_exchange_finds_classes(spark, docs):
    """Words that alternate between two sets are put into classes of one set each."""
    rng = random.Random(3)
    left, right = [f"a{i}" for i in range(8)], [f"b{i}" for i in range(8)]
    text = " ".join(f"{rng.choice(left)} {rng.choice(right)}" for _ in range(4000))
    model, _ = brown_lm.learn(docs(*([text] * 3)), classes=2, share=1000, clustered=16)
    words_of = {}
    from campusweave.llm import words as W
    import pyarrow as pa

    for word in left + right:
        at, hit = model.known.find(W.signed(W.split(pa.array([word.encode()])).hash))
        assert hit.all()
        words_of[word] = int(model.known.values["kind"][at[0]])
    assert len({words_of[x] for x in left}) == 1 == len({words_of[x] for x in right}) and words_of["a0"] != words_of["b0"]


def test_every_word_has_a_class(spark, docs):
    """Words beyond the settled and beyond the broadcast ones get classes by what stands beside them, and are scored in these at their places."""
    from campusweave.llm import words as W
    import pyarrow as pa

    rng = random.Random(5)
    left, right = [f"a{i}" for i in range(300)], [f"b{i}" for i in range(300)]
    pick = lambda x: x[int(len(x) * rng.random() ** 3)]
    train = [" ".join(f"{pick(left)} {pick(right)}" for _ in range(40)) for _ in range(150)]
    model, words_ = brown_lm.learn(docs(*train), classes=2, share=60, clustered=10)
    kinds = {r["word"]: r["kind"] for r in words_.collect()}
    of = lambda w: kinds.get(int(W.signed(W.split(pa.array([w.encode()])).hash)[0]), model.unknown)
    c = counted(train)
    seen = [w.decode() for w in c if w]
    assert len(kinds) == len(c) and len(model.known.keys) < 62 < len(seen)
    sides = [[w for w in seen if w[0] == x] for x in "ab"]
    # a word that only stands between words that are not in yet has little to go by
    assert all(sum(of(w) == of(f"{s[0][0]}0") for w in s) >= 0.95 * len(s) for s in sides) and of("a0") != of("b0")
    score = ["a299 b298 b297 a296", "a0 nobody b299", "nobody noone a299", train[0], "", None]
    for r, t in zip(sorted(brown_lm.scored(docs(*score), model, words_).collect(), key=lambda r: r["doc_id"]), score, strict=True):
        tokens = (t or "").split()
        kind = [model.end, *map(of, tokens), model.end]
        want = sum(model.moves[x, y] for x, y in zip(kind, kind[1:])) + sum(math.log10(c[w.encode()] / model.mass[of(w)]) for w in tokens if c[w.encode()])
        assert r["score"] == pytest.approx(want)
    table = docs(*train, *score)
    both = {r["doc_id"]: r["score"] for r in brown_lm.learnt_and_scored(table, F.col("doc_id") < 150, 2, 60, 10).collect()}
    assert both == pytest.approx({r["doc_id"]: r["score"] for r in brown_lm.scored(table, model, words_).collect()})


def test_language_model_untrained(spark, docs):
    model, table = brown_lm.learn(docs().limit(0))
    r = brown_lm.scored(docs("a b"), model, table).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0) and math.isfinite(r["score"])


def test_quality(spark, docs):
    good, bad = [prose(60, i, 30) for i in range(80)], [" ".join(w.upper() + "!!" for w in prose(60, 900 + i, 30).split()) for i in range(20)]
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(81, 0), (5, 0), (6, None)], "doc_id long, quality int")
    table = docs(*good, *bad, "", None, *ODD[2:])
    ratio = quality.learn(table, labels)
    out = {r["doc_id"]: r for r in quality.sampled(table, ratio).collect()}
    assert all(out[i]["kept"] for i in range(80)) and not any(out[i]["kept"] for i in range(80, 103)) and out[100]["log_ratio"] is None
    assert sum(r["kept"] for r in quality.sampled(table, ratio, 17).collect()) == 17
    assert quality.sampled(table.limit(0), ratio).collect() == []
    kept = quality.keep(table, labels)
    assert kept.schema == table.schema
    marked = quality.sampled(table, quality.learn(table, labels)).where("kept")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in marked.collect())


def test_quality_counts_once_a_task(docs):
    """A task that reads many steps of text gives a row for each bucket, not one for each step."""
    texts = [f"{'again ' * 200_000}w{i}" for i in range(4)]  # each a step of its own
    rows = quality.counted(quality.texts(docs(*texts)).coalesce(1)).collect()
    held = collections.Counter()
    for t in texts:
        held.update(quality.grams(pa.array([t.encode()]))[0].tolist())
    assert {r["bucket"]: r["n"] for r in rows} == held and len(rows) == len(held)


def test_quality_without_target(spark, docs):
    ratio = quality.learn(docs("a b c", "d"), spark.createDataFrame([], "doc_id long, quality int"))
    assert not ratio.any() and all(r["kept"] for r in quality.sampled(docs("a b c", "d"), ratio).collect())


def test_threshold(spark, monkeypatch):
    monkeypatch.setattr(quality, "CUT_ROWS", 10)
    values = [float(v) for v in [*range(500), 77, 77, 77, 10**9]]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 100, 426, 428, 504, 600):
        assert quality.threshold(df, "x", k) == sorted(values, reverse=True)[min(k, len(values)) - 1]


def der(tag, body):
    size = bytes([len(body)]) if len(body) < 128 else (b"\x82" + len(body).to_bytes(2, "big"))
    return bytes([tag]) + size + body


def test_secrets(spark, docs):
    key = der(0x30, b"".join(der(2, bytes([i + 1]) * n) for i, n in enumerate((1, 64, 3, 64, 32, 32, 32, 32, 32))))
    spki = der(0x30, der(0x30, der(6, bytes.fromhex("2b6570"))) + der(3, b"\x00" + b"k" * 32))
    ssh = b"\x00\x00\x00\x0bssh-ed25519\x00\x00\x00\x20" + b"p" * 32
    token = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=") + ".e30.c2ln"
    b64 = lambda x: base64.b64encode(x).decode()
    text = f"é {token} and {b64(key)} {b64(ssh)}\n-----BEGIN PUBLIC KEY-----\n{b64(spki)}\n-----END PUBLIC KEY-----\n{spki.hex()} {b64(b'just some text that is long enough')}"
    spans = secrets.structural_spans(text)
    assert [k for k, _, _ in secrets.ordered(spans)] == ["signed_token", "der_key", "ssh_key", "pem", "der_key"]
    assert text[spans[0][1] : spans[0][2]] == token
    assert not secrets.der_key(key[:-1]) and not secrets.der_key(key + b"\x00") and not secrets.token_header("eyJub3QiOiJvbmUifQ")
    rows = {r["doc_id"]: r for r in secrets.scan(docs(text, *ODD, "API_KEY='abcdef' Token:short1 passwd = x", "AKIA" + "A" * 16 + " " + "0a" * 12)).collect()}
    assert rows[6]["base_spans"] == "assign:0:15,assign:17:29" and (rows[7]["n_access"], rows[7]["n_hex"]) == (1, 1)
    assert all(rows[i]["spans"] == "" for i in range(1, 6))
    out = {r["doc_id"]: r["text"] for r in secrets.redact(docs(text, None, "secret: abcdefg.")).collect()}
    assert token not in out[0] and out[1] is None and out[2] == "[assign]" and not secrets.structural_spans(out[0])


@DATA
def test_op8_against_plain_rules(spark):
    import hashlib
    import re

    kinds = [("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", r"(AKIA[A-Z0-9]+)", 20), ("hex", r"([0-9a-f]+)", 24)]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op8_secrets"](spark, SF).collect():
        spans = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, rule, n) in enumerate(kinds) for m in re.finditer(rule, texts[r["doc_id"]]) if len(m[1]) >= n]
        assert r["base_sha256"] == hashlib.sha256(",".join(s for _, _, s in sorted(spans)).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(i == j for _, i, _ in spans) for j in range(3)]


@pytest.mark.skipif(not os.path.exists(sentencepiece.MODEL), reason="no tokenizer files")
class TestPieces:
    def test_equals_the_library(self, spark):
        import sentencepiece as library

        model, coder = library.SentencePieceProcessor(model_file=sentencepiece.MODEL), sentencepiece.Encoder(sentencepiece.load())
        rng = random.Random(4)
        texts = ["", "a", " ", "  lead", "trail  ", "Hello  world\nfoo", "漢字 é🙂 ﬁ①", "a" * 900, "<s> <0x41> </s>", "def f(x):\n\treturn x", "▁x", "\x00\x7f"]
        texts += ["".join(rng.choice("abcdeéß thinlouer \n.,12漢") for _ in range(rng.randrange(200))) for _ in range(300)]
        if os.path.isdir(SF):
            texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
        ids = coder.encode(texts)
        assert ids == model.encode(texts)
        assert [coder.decode(i) for i in ids] == model.decode(ids)
        assert all(coder.decode(i) == t for i, t in zip(ids, texts, strict=True) if "▁" not in t)

    def test_units_of_like_length_go_together(self, monkeypatch):
        """One lattice for lengths 8 to 15, the same ids as the library's, also where pairs push each other out."""
        import sentencepiece as library

        model = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
        rng = random.Random(6)
        text = " ".join("".join(rng.choice("etaoinshrdlué漢") for _ in range(7 + i % 8)) for i in range(400))
        calls = []
        for bits in (sentencepiece.PAIRS, 3):
            monkeypatch.setattr(sentencepiece, "PAIRS", bits)
            coder = sentencepiece.Encoder(sentencepiece.load())
            run = coder.viterbi
            coder.viterbi = lambda units, run=run: calls.append(len(units)) or run(units)
            assert coder.encode([text]) == [model.encode(text)]
        assert calls == [400, 400]

    def test_tables(self, spark, docs):
        out = sentencepiece.encoded(docs("one two", *ODD, (0, "one two")))
        rows = out.collect()
        assert len(rows) == 7 and sum(r["doc_id"] == 0 for r in rows) == 2 and [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)] == [0, 0]
        assert {r["doc_id"]: r["text"] for r in sentencepiece.decoded(out).collect()}[0] == "one two"
        odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
        assert [r["text"] for r in sentencepiece.decoded(odd).collect()] == ["", ""]


def test_unigram_viterbi_is_the_best_path():
    """For a unigram model the batched pass finds the greatest sum, as trying all segmentations does."""
    names = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca"]
    rng = random.Random(5)
    pieces = sentencepiece.Pieces(names, [-rng.uniform(1, 5) for _ in names], [True] * len(names), merging=False)
    coder = sentencepiece.Encoder(pieces)

    def best(s):
        options = [(pieces.score[s[:n]] + rest, [s[:n], *p]) for n in range(1, len(s) + 1) if s[:n] in pieces.id for rest, p in [best(s[n:])]]
        return max(options, default=(0.0, [])) if s else (0.0, [])

    for s in ["abc", "abcab", "cabca", "aabbcc", "bcabcabca"]:
        assert [names[i] for i in coder.encode([s])[0]] == best("▁" + s)[1]
