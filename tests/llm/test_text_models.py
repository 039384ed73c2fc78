"""Token files, quality and language against direct computation."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookweave.llm import common, language, quality, textkit, token_files

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, _stats string"
ODD = [None, "", " ", "\n\n", "a", "a  b \n\n c\t\td", "x  <|endoftext|>  y", "naïve café  ok", "don't 's  1234 !!", "é" * 500, "日本語 テキスト", "a b " * 30_000, "same", "same"]


def frame(spark, texts, langs=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], None, None, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def expected_tokens(texts):
    tok, start, out = tokenizers.Tokenizer.from_file(PATH), 0, []
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_token_files_round_trip(spark):
    out = token_files.op10_token_files(spark, frame(spark, ODD).repartition(3), PATH)
    assert sorted(map(tuple, out.collect())) == expected_tokens(ODD)


def test_token_files_of_empty_table_and_documents(spark, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    assert token_files.op10_token_files(spark, empty, PATH).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    assert sorted(map(tuple, token_files.op10_token_files(spark, docs, PATH).collect())) == expected_tokens(texts)


def test_sequence_is_mapped_without_copy(spark, tmp_path):
    m = token_files.write(frame(spark, ODD[:10]), str(tmp_path / "out"), PATH, length=16, rows=2)
    row = m.orderBy("part").first()
    ids, mask = token_files.sequence(row.data, 0)
    assert len(ids) == len(mask) == 16 and not ids.flags.owndata


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab .,'\n\t é!1<|\u2003\u2014\xa0\x1d", max_size=40), max_size=5))
def test_pieces_equal_whole_texts(texts):
    coder, tok = token_files.encoder_of(PATH, 0), tokenizers.Tokenizer.from_file(PATH)
    texts = [*texts, "".join(texts) + "<|endoftext|> " + "".join(texts)]
    got = [i for _, _, data, offsets in textkit.runs(pa.array(texts, pa.string()), 30) for i in coder.run(data, offsets)[0].tolist()]
    assert got == [i for t in texts for i in [*tok.encode(t, add_special_tokens=False).ids, 0]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \n\x0b", max_size=30), max_size=6), st.integers(1, 4))
def test_shingles(texts, k):
    got = []
    for _, _, data, offsets in textkit.runs(pa.array(texts, pa.string()), 20):
        sh, at = textkit.shingles(*textkit.words(data, offsets), k)
        got += [sh[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    plain = []
    for t in texts:
        w = [x for x in "".join(c.lower() if c.isascii() else c for c in t).replace("\n", " ").replace("\x0b", " ").split(" ") if x]
        plain.append([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [("short", *w)] * bool(w))
    names = {}
    for a, b in zip(got, plain, strict=True):
        assert len(a) == len(b)
        for x, y in zip(a, b, strict=True):
            assert names.setdefault(y, x) == x
    assert len(set(names.values())) == len(names)


def test_quality_on_held_out_rows(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.op2_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0.7 < kept.count() / docs.count() < 0.95
    good = {r.doc_id for r in quality.op2_quality(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good
    monkeypatch.setattr(common, "CARRIED", -1)
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == good


def test_quality_of_odd_rows(spark):
    docs, none = frame(spark, ODD), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in quality.op2_quality(docs, none).collect()} == {(0.5, 0)}
    ids = [i for i in range(len(ODD)) if zlib.crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(i, i % 2, None) for i in ids * 2] + [(0, None, None)], "doc_id long, quality int, toxic int")
    rows = quality.op2_quality(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality.op2_quality(frame(spark, ODD).limit(0), labels).collect() == []


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.op7_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_language_of_odd_rows(spark):
    langs = [["aa", "bb", None][i % 3] for i in range(len(ODD))]
    rows = {r.doc_id: r for r in language.op7_language(frame(spark, ODD, langs)).collect()}
    assert len(rows) == len(ODD)
    for i, t in enumerate(ODD):
        letters = any(c.isalpha() for c in t or "")
        assert (rows[i].lang_pred in ("aa", "bb")) == letters and (letters or rows[i].score == 0)
    one = language.op7_language(frame(spark, ["abc", "1", None])).collect()
    assert [r.lang_pred for r in one] == ["en", "und", "und"]
    assert language.op7_language(frame(spark, [])).collect() == []


def test_codewords_part_every_two_languages():
    for k in (2, 3, 4, 5, 8, 30):
        code = language.codewords(k)
        assert len({tuple(r) for r in code}) == k and (np.abs(code.sum(0)) < k).all()


def test_language_functions_are_defined_once():
    import ast
    import inspect

    names = [n.name for n in ast.parse(inspect.getsource(language)).body if isinstance(n, (ast.FunctionDef, ast.ClassDef))]
    assert len(names) == len(set(names))
    assert list(inspect.signature(language.predict).parameters) == ["docs", "model"]


def test_other_tokenizers_encode_whole_texts(spark, tmp_path):
    """A tokenizer that folds case and drops white space, and the usual one with a prefix blank: no piece is encoded apart."""
    prefixed = tokenizers.Tokenizer.from_file(PATH)
    prefixed.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=True)
    prefixed.save(str(tmp_path / "prefixed.json"))
    assert token_files.piecewise(tokenizers.Tokenizer.from_file(PATH))
    for path in (public.path("word_bpe_49k.json"), str(tmp_path / "prefixed.json")):
        tok = tokenizers.Tokenizer.from_file(path)
        assert not token_files.piecewise(tok)
        coder = token_files.PieceEncoder(path)
        ids, counts = coder.run(*textkit.text_bytes(pa.array(ODD)))
        want = [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in ODD]
        assert ids.tolist() == [i for t in want for i in t] and counts.tolist() == [len(t) for t in want]


def plain_statistics(text):
    """The twenty statistics by loops over bytes and words."""
    data = (text or "").encode()
    groups = [b" \t", b"\n\r\v\f", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:", b"!?", b"'\"()-", b"|", b"#$%&*@^~<>=+_\\/`{}[]", bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0))]
    kind = lambda b: next((n for n, g in enumerate(groups, 1) if b in g), 0)
    kinds = [sum(kind(b) == k for b in data) for k in range(13)]
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0d]+", data) if w]
    lines = [x for x in data.split(b"\n") if x]
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    pairs = set(zip(low, low[1:], strict=False)) if len(low) > 1 else set(low)
    n, sizes = max(len(words), 1), [len(w) for w in words]
    mean = sum(sizes) / n
    spread = max(sum(x * x for x in sizes) / n - mean**2, 0) ** 0.5
    some, letters = max(len(data), 1), max(kinds[3] + kinds[4], 1)
    share = lambda x, of: (x / of) ** 0.5
    return [
        *np.log1p([len(data), len(words), mean, spread]), share(kinds[4], letters), share(kinds[5], some), share(kinds[6], n + kinds[6]), share(kinds[7], n + kinds[7]), share(kinds[8], some),
        share(kinds[9], n + kinds[9]), share(kinds[10], some), share(kinds[11], some), share(kinds[0], some), share(sum(kind(w[-1]) in (7, 9, 10) for w in words), n), share(sum(x <= 3 for x in sizes), n),
        share(len(set(low)), n), share(max((low.count(w) for w in set(low)), default=0), n), share(len(pairs), n), share(len(set(lines)), max(len(lines), 1)), share(len(lines), n),
    ]


def test_statistics_against_plain_loops():
    texts = [*ODD[:11], "Wow! One|two|three #4 {x} A.B. \x01\n\nline\nline\nLINE two two TWO", "é ü\xa0ß", *(t for t in ["a!b? c|", " x"])]
    np.testing.assert_allclose(quality.statistics(pa.array(texts)), [plain_statistics(t) for t in texts], atol=1e-9)


def plain_grams(text):
    """Shares of hashed 2-grams and 3-grams, one place after the other."""
    letters = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()]
    out = np.zeros(language.WIDTH)
    for n in (2, 3):
        for i in range(len(letters) - n + 1):
            g = letters[i : i + n]
            if g[0] != g[1]:
                out[(sum(x << 8 * (n - 1 - k) for k, x in enumerate(g)) * 2654435761 % 2**32) >> 20] += 1
    return out / max(out.sum(), 1)


def test_language_against_plain_loops():
    texts = [t for t in ODD if t and len(t) < 1_000] + ["Der schnelle Fuchs", "le renard rapide", "the quick fox"] * 3
    shares = np.concatenate([s for _, _, s in language.grams(pa.array(texts))])
    np.testing.assert_allclose(shares, [plain_grams(t) for t in texts], atol=1e-12)
    y = np.array([i % 3 for i in range(len(texts))])
    model = language.train(shares[-9:].astype(np.float32).copy(), y[-9:], ["de", "en", "fr"])
    best, score, close = model.predict(pa.array(texts))
    for i, s in enumerate(shares):
        loss = [sum(t * np.log1p(np.exp(-np.clip((s @ model.weights[:, b] + model.bias[b]) * model.code[k, b], -30, None))) for b, t in enumerate(model.trust)) for k in range(3)]
        order = np.sort(loss)
        assert best[i] == int(np.argmin(loss)) and abs(score[i] - 1 / sum(np.exp(order[0] - x) for x in loss)) < 1e-6
        assert close[i] == (order[1] - order[0] < 0.1 * model.trust.sum())
    assert best[-9:].tolist() == y[-9:].tolist()


def test_language_fit_measures_its_sample_in_parallel(spark):
    """The sampled texts are measured where they lie; one task sorts only what was measured."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs, sample=200)
    again = language.fit(docs.repartition(5), sample=200)
    assert model.langs == again.langs and np.allclose(model.weights, again.weights)
