import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language
from millrace.llm.language import Profiles, document_vectors, identify, predict
from millrace.llm.queries import held_out, op1_language_id

SMALL = Profiles(dimensions=128, seed=3, train_docs=50)


def brute_vector(text, profiles):
    """Every trigram bound letter by letter."""
    out = np.zeros(profiles.dimensions)
    lower = text.lower()
    words, word = [], ""
    for c in lower + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    for w in words:
        padded = " " + w + " "
        for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
            vectors = [language._letter(ord(x), profiles) for x in (a, b, c)]
            out += np.roll(vectors[0], 2) * np.roll(vectors[1], 1) * vectors[2]
    return out


def test_vectors_bundle_bound_trigrams(texts):
    extra = ["Ünï", "a", "日本語 テキスト 漢字", "x-y_z 12", "İstanbul ǅ"]
    got = document_vectors(texts + extra, SMALL)
    for vector, text in zip(got, texts + extra, strict=True):
        assert np.array_equal(vector, brute_vector(text or "", SMALL))


def test_large_alphabets_and_small_blocks(texts, monkeypatch):
    wide = ["".join(chr(0x4E00 + (i * j) % 900) for i in range(400)) for j in range(1, 8)]
    expected = [brute_vector(t, SMALL) for t in wide]
    monkeypatch.setattr(language, "BLOCK_CELLS", 3000)
    monkeypatch.setattr(language, "BLOCK_CHARS", 900)
    assert np.array_equal(document_vectors(wide, SMALL), np.stack(expected))


def test_unknown_texts():
    assert predict([None, "", "12 .. 3", "é"], {"fr": np.ones(128) / 128**0.5}, SMALL)[0] == ["und", "und", "und", "fr"]
    assert predict(["abc"], {}, SMALL) == (["und"], [0.0])


def test_learns_only_from_allowed_rows(docs):
    rows = [(i, "the stone and the mill", "en", "s") for i in range(5)] + [(10 + i, "der stein und die mühle", "de", "s") for i in range(5)]
    rows += [(99, "le moulin et la pierre", "fr", "s"), (98, "nada de nada", None, "s"), (None, "the mill", "en", "s"), (0, "the stone and the mill", "en", "s")]
    frame = docs(rows, 4, ["lang_pred", "score", "key"])
    got = identify(frame, SMALL, F.coalesce(F.col("doc_id"), F.lit(0)) < 90).select("doc_id", "lang_pred", "score").collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got} == {"en", "de"}
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by_id[3] == "en" and by_id[12] == "de"


def test_nothing_to_learn_and_empty_table(docs):
    assert [r["lang_pred"] for r in identify(docs([(1, "word", None, "s")]), SMALL, F.lit(True)).collect()] == ["und"]
    assert identify(docs([], 1), SMALL, F.lit(True)).collect() == []


def test_too_many_languages(docs):
    frame = docs([(i, "abc", f"l{i}", "s") for i in range(4)])
    with pytest.raises(ValueError, match="more than 3 languages"):
        identify(frame, Profiles(dimensions=16, max_languages=3), F.lit(True))


def test_held_out_accuracy(spark, small, table):
    truth = {r["doc_id"]: r["lang"] for r in table("documents").select("doc_id", "lang").collect()}
    got = op1_language_id(spark, small).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_missing_id_is_not_held_out(docs):
    assert [r[0] for r in docs([(None, "a")]).select(held_out()).collect()] == [False]


def test_blocks_never_cut_words(monkeypatch):
    """A text's vector doesn't depend on where it is cut into pieces."""
    from millrace.llm import language

    profiles = language.Profiles(dimensions=64, seed=3, train_docs=10)
    texts = ["der längste Satz, ohne Ende; " * 9, "x" * 100, "a b c", "...", None, "word\nword  two"]
    whole = language.document_vectors(texts, profiles)
    for size in (1, 7, 50):
        monkeypatch.setattr(language, "PIECE", size)
        assert (language.document_vectors(texts, profiles) == whole).all()
