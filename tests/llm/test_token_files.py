"""Token files against the plain library call, with null and repeated ids, special tokens and many files."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanwork.llm import token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["hi <|endoftext|> x", "a  b\n\nc \n d\t e", "<|endoftext|>", "", "  ", "\n", " x", "x ", "it's we'll 'S", "é 語 　 a᠎b \x1c y",
       "foo, bar. baz.,", "<|endoftext|", "a\x00b \x00 c", "  lead", "tail  ", "12 345,6 $5.00", "\r\n x\r\ny", "x" * 50_000]


def plain(text):
    ids = Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


def test_the_encoder_is_the_library():
    encoder = token_files.ByteEncoder(FILE)
    texts = ODD + [a + " " + b for a in ODD[:-1] for b in ODD[:-1]]
    for _ in range(2):  # new words, then words that are known
        assert encoder.encode(texts) == [plain(t) for t in texts]


def test_null_and_repeated_ids_stay_in_order(spark, tmp_path):
    rows = [(None, "no id", 1), (None, None, 1), (7, "seven a", 1), (7, "seven b", 1), (7, "seven b", 1), *[(10 + i, t, 1) for i, t in enumerate(ODD)]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    token_files.write_token_files(docs, str(tmp_path / "f"), FILE, text_per_file=10_000)
    files = token_files.read_token_files(spark, str(tmp_path / "f"))
    got = token_files.starts(files).join(token_files.checksums(files), ["file", "row"]).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 7, 7, 7, *range(10, 10 + len(ODD))]
    end = np.array([0], "<u4").tobytes()
    want = sorted((i or 0, len(plain(t)) // 4 + 1, zlib.crc32(plain(t) + end)) for i, t, _ in rows)
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()


def test_files_count_by_number_beyond_five_digits(spark):
    names = ["part-00002-x.c000.zstd.parquet", "part-99999-x.c000.zstd.parquet", "part-100000-x.c000.zstd.parquet"]
    files = spark.createDataFrame([(n, r, 10 * i + r, 5 + i) for i, n in enumerate(names) for r in range(2)],
                                  "file string, row bigint, doc_id bigint, n_tokens bigint")
    got = {r.doc_id: r.start for r in token_files.starts(files).select("doc_id", F.col("start")).collect()}
    assert got == {0: 0, 1: 5, 10: 10, 11: 16, 20: 22, 21: 29}


def test_words_of_letters_skip_the_word_pattern():
    encoder = token_files.ByteEncoder(FILE)
    patterned, library = [], encoder._library
    encoder._library = lambda texts: patterned.extend(texts) or library(texts)
    letters = ["Thndre erblen.\nOfnge\nélèveçon, ªµº ÿɏx a", "x", "Thndre Ofnge."]
    assert encoder.encode(letters) == [plain(t) for t in letters]
    assert not [t for t in patterned if any(map(str.isalpha, t))]
    others = ["Жук 12 x9 ɐb é9", "a\n\nb \n c\n", "\n", "\na b", "a\t\nb", "x.\ny,\nz", "a'\ns 't\nre"]
    assert encoder.encode(others) == [plain(t) for t in others]
    assert patterned


def test_lines_are_no_words_of_the_memo():
    encoder = token_files.ByteEncoder(FILE)
    texts = [f"{a} one.\n{b} two" for a in ("Abe", "Bce", "Cde") for b in ("Xyz", "Yzx", "Zxy")]
    assert encoder.encode(texts) == [plain(t) for t in texts]
    assert not [w for w in encoder.known if "\n" in w and w != "\n"]
