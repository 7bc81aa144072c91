import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankweave.llm import token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_give_the_librarys_ids():
    plain = Tokenizer.from_file(PATH)
    texts = ["", " ", "it's we're I'LL 's ''s '", "a  b   c\n\n d\t\te \n", "x<|endoftext|>y", "日本語 テキスト", "é b c\x1cd\x85e", "naïve  coöperate ¿qué? 12 345³", "😀 a😀b", "é x", "\r\n\r\n a", "!" * 500 + " " * 77 + "z"]
    encoder = tf.PieceEncoder(PATH)
    for ids, text in zip(encoder.encode(texts) , texts, strict=True):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, tf.END], text


def test_parts_cut_at_marks_and_line_ends_give_the_librarys_ids():
    plain, encoder, rng = Tokenizer.from_file(PATH), tf.PieceEncoder(PATH), random.Random(1)
    bits = ["a", "B", "é", " ", " ", "\n", "\n", ".", ",", "!?", "'s", "'", "12", "x1", "\t", "-", "ª", "²", "<|endoftext|>", "the", "\r", tf.NO_BLANK]
    texts = ["".join(rng.choice(bits[: rng.choice([12, 20, 22])]) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for ids, text in zip(encoder.encode(texts), texts, strict=True):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, tf.END], repr(text)


def test_a_word_is_encoded_once_whatever_marks_follow_it(monkeypatch):
    encoder, calls = tf.PieceEncoder(PATH), []
    plain = encoder.tokenize
    encoder.tokenize = lambda piece: calls.append(piece) or plain(piece)
    encoder.encode(["one two, one. Two!\nOne one", "one, two:\ntwo"])
    words = [c for c in calls if c[-1].isalpha() and len(c) > 1]
    assert len(words) == len(set(words)) == 6
    monkeypatch.setattr(tf, "CACHE", 3)
    encoder.encode(["three four five six"])
    assert len(encoder.parts) == 4  # those of the last call


def test_files_give_back_every_document(spark):
    folder = "/root/testdata/sf0.001"
    plain = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in tf.op7_token_files(spark, folder).collect()}
    assert rows.keys() == texts.keys()
    start = 0
    for key in sorted(texts):
        ids = np.array([*plain.encode(texts[key], add_special_tokens=False).ids, 2], "<u4")
        assert (rows[key].start, rows[key].n_tokens, rows[key].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_selective_reads_and_edge_cases(spark):
    data = [(3, None, "en"), (1, "", "de"), (2, "one two", "en"), (5, "long " * 30_000, None), (None, "no id", "en"), (2, "one two", "en")]
    docs = spark.createDataFrame([(*d, 7) for d in data], "doc_id long, text string, lang string, ids int")
    files = tf.write_token_files(docs, PATH)
    assert files.count() == 6
    assert [len(r.ids) for r in tf.read_tokens(files, 1, 3).orderBy("doc_id", "ids").collect()] == [1, 3, 3, 1]
    plan = tf.read_tokens(files, 1, 3)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,1)" in plan and "lang" not in plan
    assert tf.digest(tf.write_token_files(docs.limit(0), PATH)).count() == 0


def test_rows_of_one_id_start_in_the_files_order(spark):
    docs = spark.createDataFrame([(4, t) for t in ("b c d", "a", "a", None, "a b")] + [(5, "z")], "doc_id long, text string").repartition(3)
    files = tf.write_token_files(docs, PATH)
    order = [(r.doc_id, len(r.ids)) for r in files.orderBy(F.input_file_name(), "place").collect()]
    assert [n for _, n in sorted(order, key=lambda x: x[0])][:5] == [1, 2, 2, 3, 4]  # ordered by text, null first
    rows = sorted(tf.digest(files).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == [0, 1, 3, 5, 8, 12] and [r.n_tokens for r in rows] == [1, 2, 2, 3, 4, 2]


def test_another_split_goes_whole_to_the_library(tmp_path):
    import json

    spec = json.load(open(PATH))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(spec))
    encoder, plain = tf.PieceEncoder(str(tmp_path / "other.json")), Tokenizer.from_file(str(tmp_path / "other.json"))
    assert not encoder.splits and tf.PieceEncoder(PATH).splits
    assert encoder.encode(["the cat"])[0].tolist() == [*plain.encode("the cat", add_special_tokens=False).ids, tf.END]


def test_ids_are_delta_encoded(spark):
    import pyarrow.parquet as pq

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    files = tf.write_token_files(docs, PATH)
    meta = pq.ParquetFile(files.inputFiles()[0].removeprefix("file:").replace("//", "/")).metadata.row_group(0)
    by = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in by["ids.list.element"].encodings
    assert any("DICTIONARY" in e for e in by["lang"].encodings)
    assert by["doc_id"].has_column_index and by["doc_id"].has_offset_index
