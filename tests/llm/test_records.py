import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm.crc32c import crc32c, masked
from millrace.llm.records import FORMAT, frames, in_order, payloads, read_records, shuffled_records, write_records
from millrace.llm.tokens import Encoder, Vocabulary, token_records

WORDS = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums_equal_a_plain_loop():
    rng = np.random.default_rng(3)
    strings = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 3, 4, 127, 128, 129, 0, 256, 1000, 5000)]
    strings += [b"123456789", bytes(400), b"\xff" * 300]
    found = crc32c(np.frombuffer(b"".join(strings), np.uint8), [len(s) for s in strings])
    assert found.tolist() == [plain_crc32c(s) for s in strings]
    assert found[-3] == 0xE3069283  # the check value of this checksum
    crc = int(found[-3])
    assert masked(found[-3:-2])[0] == ((crc >> 15 | crc << 17 & 0xFFFFFFFF) + 0xA282EAD8) % (1 << 32)
    assert crc32c(np.zeros(0, np.uint8), []).tolist() == []


def test_frames_are_read_back_and_damage_is_found():
    found = frames([b"", b"abc", b"x" * 1000])
    data, offsets = b"".join(found), np.cumsum([0] + [len(f) for f in found])
    assert payloads(data, offsets, "f") == [b"", b"abc", b"x" * 1000]
    assert found[1][:8] == (3).to_bytes(8, "little") and len(found[1]) == 19
    for at in (2, 9, 30, 33, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            payloads(bytes(bad), offsets, "f")


def expected(rows):
    """Sorted (key, start, ids) by the library on whole texts."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS.path)
    encoded = [(k, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for k, t in rows]
    out, start = [], 0
    for k, ids in sorted(encoded, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def digest(df):
    shown = df.select("key", "start", (F.octet_length("ids") / 4).cast("int"), F.crc32("ids"))
    return sorted((tuple(r) for r in shown.collect()), key=lambda r: r[1])


ODD = ["<|endoftext|> a<|startoftext|>b", "it's Σίσυφος ΟΔΟΣ\x0bnext\x0cpage\x1cfs\x85nel ls nbsp", "é ́ x́", "日本語 テキスト　全角", "İstanbul ǅ ﬁ"]
ODD += ["x<y <|ok> ªº²³¹½ naïve_ſtraße¡¿Ünï\u0130\u0131 ÀÉ\xad\xa0ǅǆ ŉ A1b22,c...D --e'S 'LL O'Neil`s «q»"]
ODD += ["don't we'll I'd 3.14159 !!??", "각 한글", "a\r\nb\tc", "😀".encode("utf-16", "surrogatepass").decode("utf-16") + " ok", " "]


def test_ids_by_piece_equal_those_of_whole_texts(docs, texts):
    rows = list(enumerate([*texts, *ODD]))
    assert digest(token_records(docs(rows), WORDS)) == expected(rows)


def test_whole_texts_and_full_tables_of_pieces(monkeypatch):
    import pyarrow as pa

    from millrace.llm import tokens

    monkeypatch.setattr(tokens, "KNOWN_PARTS", 3)
    texts = pa.array(["one two three", "", "two four five six", "one"], pa.large_string())
    by_piece = Encoder(WORDS)
    assert by_piece.ids(texts) == Encoder(Vocabulary(WORDS.path, by_piece=False)).ids(texts) == by_piece.ids(texts)


def test_vocabularies_of_another_kind_run_whole():
    import pyarrow as pa

    kept = Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), end_id=50256)
    texts = pa.array(["Blanks and Case count  here", ""], pa.large_string())
    with pytest.raises(ValueError, match="by_piece=False"):
        Encoder(kept)
    whole = Encoder(Vocabulary(kept.path, 50256, by_piece=False))
    ids = [np.frombuffer(v, "<u2").tolist() for v in whole.ids(texts)]
    assert ids[1] == [50256] and whole.tokenizer.decode(ids[0][:-1]) == "Blanks and Case count  here"


def test_vocabulary_must_fit():
    with pytest.raises(ValueError, match="2 or 4 bytes"):
        Encoder(Vocabulary(WORDS.path, width=1))
    with pytest.raises(ValueError, match="don't fit"):
        Encoder(Vocabulary(WORDS.path, end_id=1 << 16))


def test_keys_missing_repeated_and_extra_columns(docs):
    rows = [(None, "no key"), (3, "same id"), (3, "other text"), (3, "same id"), (1, None), (2, ""), (-5, "below")]
    frame = docs(rows).withColumns({c: F.lit("x") for c in ("key", "ids", "start", "value", "tie", "row", "file", "at")})
    found = digest(token_records(frame, WORDS))
    assert sorted(map(repr, [(r[0], *r[2:]) for r in found])) == sorted(map(repr, [(r[0], *r[2:]) for r in expected(rows)]))
    assert [r[0] for r in found] == [None, -5, 1, 2, 3, 3, 3]
    assert [r[1] for r in found] == np.cumsum([0] + [r[2] for r in found])[:-1].tolist()


def test_empty_table(docs):
    assert token_records(docs([]), WORDS).collect() == []


def test_wide_ids_and_shuffled_reads(spark, tmp_path):
    path = f"file://{tmp_path}/records"
    rows = [(i % 50 if i else None, np.arange(i % 7, dtype="<u4") * 70_000) for i in range(300)]
    frame = spark.createDataFrame([(k, v.tobytes()) for k, v in rows], "k bigint, v binary").repartition(5)
    ordered = in_order(frame, "k", "v").withColumnRenamed("value", "ids")
    write_records(ordered, path, width=4)
    back = read_records(spark, path).orderBy("start", "file", "at").collect()
    assert sorted(repr((r.key, bytes(r.ids))) for r in back) == sorted(repr((k, v.tobytes())) for k, v in rows)
    assert [r.key for r in back][1:] == sorted(k for k, _ in rows[1:])
    index = read_records(spark, path, index_only=True)
    assert index.count() == 300 and index.agg(F.max(F.col("start"))).first()[0] <= sum(len(v) for _, v in rows)

    def read(seed):
        got = shuffled_records(spark, path, seed).collect()
        assert [r.turn for r in got] == sorted(r.turn for r in got)
        return [(r.file, r.at, r.key, bytes(r.ids)) for r in got]

    assert read(1) == read(1) != read(2)
    assert sorted(read(2), key=repr) == sorted(((r.file, r.at, r.key, bytes(r.ids)) for r in back), key=repr)


def test_damaged_file_fails_the_read(spark, tmp_path):
    path = f"{tmp_path}/records"
    write_records(spark.createDataFrame([(1, b"\1\0\2\0")], "key bigint, ids binary"), path, width=2)
    name = next(tmp_path.glob("records/*.rec"))
    data = bytearray(name.read_bytes())
    data[-6] ^= 1
    name.write_bytes(bytes(data))
    with pytest.raises(Exception, match="checksum"):
        spark.read.format(FORMAT).load(path).collect()
