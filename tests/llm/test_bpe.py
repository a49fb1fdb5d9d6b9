"""BPE and token counts against the tokenizers library on whole texts."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from renewcast.llm.bpe import decode, encode, op7_bpe
from renewcast.llm.shared import scratch
from renewcast.llm.token_files import op10_token_counts, scan_counts, write_token_files


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def brute(t, rows):
    out = []
    for d, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, df.select("doc_id", (F.octet_length("ids") / 4).cast("int"), F.sha2("ids", 256), F.sha2(F.col("decoded").cast("binary"), 256)).collect()), key=str)


def test_table(spark, sf, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op7_bpe(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=str) == brute(library, rows)


def test_odd_and_long_texts(spark, odd, library):
    rng = random.Random(3)
    letters = "abcdefghij éß漢字😀12'"
    unsplit = "".join(rng.choice(letters.replace(" ", "")) for _ in range(30000))
    rows = [(20, unsplit), (21, "a" * 20000), (22, "x " + unsplit[:9000] + " \n" + unsplit[500:9000]), (23, "<|endoftext|> It's<|startoftext|>we'll  done"), (24, "É́ İ ﬁ​")]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute(library, [tuple(r) for r in df.collect()])
    assert digest(decode(encode(df))) == want
    assert digest(encode(df, decoded="decoded")) == want
    assert digest(decode(encode(df, part=5000))) == want
    assert digest(encode(df.repartition(5), part=2000, decoded="decoded")) == want


def test_parts_keep_their_rows(spark, library):
    """Long texts by parts after a repartition, with other columns whose names the operator uses itself."""
    rng = random.Random(5)
    rows = [(i, f"r{i}", i, "".join(rng.choice("abc de\n") for _ in range(rng.choice([20, 900])))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, row string, part int, text string").repartition(4)
    got = encode(df, part=300, decoded="decoded")
    assert digest(got) == brute(library, [(i, t) for i, _, _, t in rows])
    assert sorted((r["doc_id"], r["row"], r["part"], r["text"]) for r in got.collect()) == sorted(rows)
    assert digest(encode(df.limit(0), part=300, decoded="decoded")) == []


def test_words_of_equal_polynomial_hash(spark, library):
    """A Thue-Morse word of 2048 letters and its complement, which polynomial hashes modulo 2**64 confuse."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    words = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
    rows = [(1, words[0] + " x " + words[1]), (2, words[1]), (3, words[0])]
    assert digest(encode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), decoded="decoded")) == brute(library, rows)


def test_text_of_several_parts(spark, library):
    """Over 1 MiB, with and without white space, at the default size of parts."""
    rng = random.Random(7)
    unsplit = "".join(rng.choice("abcdefghij12'é") for _ in range(150_000))
    rows = [(1, unsplit), (2, " ".join("".join(rng.choice("lorem") for _ in range(rng.randrange(1, 9))) for _ in range(260_000)))]
    assert len(rows[1][1]) > 1 << 20
    assert digest(encode(spark.createDataFrame(rows, "doc_id long, text string"), decoded="decoded")) == brute(library, rows)


def test_token_counts(spark, sf, library):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    plain.no_truncation()
    plain.encode_special_tokens = True
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r["doc_id"], len(plain.encode(r["text"] or "", add_special_tokens=False).ids)) for r in rows)
    assert sorted(map(tuple, op10_token_counts(spark, sf).select("doc_id", "n_tokens").collect())) == want


def test_blocks_are_stitched(spark, odd):
    folder = scratch(spark, "tokens")
    which = write_token_files(odd.coalesce(2), folder).collect()
    whole = sorted(map(tuple, scan_counts(spark, folder).collect()))
    assert len(whole) == len(which)
    for block, span in ((2, 3), (6, 2), (100, 4096)):
        assert sorted(map(tuple, scan_counts(spark, folder, block=block, span=span).collect())) == whole


def test_token_files_of_odd_tables(spark, odd):
    folder = scratch(spark, "tokens")
    df = odd.withColumnRenamed("gone", "path").withColumn("doc_no", F.lit("mine"))
    which = write_token_files(df, folder).collect()
    assert sorted(str(r["doc_id"]) for r in which) == sorted(str(r["doc_id"]) for r in df.collect())
    counts = {(r["path"].rpartition("/")[2], r["doc_no"]): r["n_tokens"] for r in scan_counts(spark, folder).collect()}
    tokens = {r["doc_id"]: counts[r["path"].rpartition("/")[2], r["doc_no"]] for r in which}
    assert tokens[1] == tokens[2] == tokens[3] == 0 and tokens[4] == tokens[5] == 3 and tokens[7] == tokens[8]
    assert write_token_files(odd.limit(0), scratch(spark, "tokens")).count() == 0
