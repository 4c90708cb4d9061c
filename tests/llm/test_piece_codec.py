import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from silvermill.llm import piece_codec as P
from silvermill.llm.queries import op12_sentencepiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  a  b  ", "a\tb\n\n c\r\n", "▁", "▁▁a ▁", "<s></s><unk><0x0A>",
    "ﬁ Ａ́ é é", "\U0001F600\U0001F600 日本語", "\x00a\x00 \x00", "� ￾", "x" * 5000,
    " " * 3000, "a " * 3000, "▁" * 70 + "z", "​  　b", "The quick brown fox, don't 12345.67 stop-now",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def expected(library, docs):
    rows = [(i, [*library.encode(text or ""), library.eos_id()]) for i, text in docs]
    return sorted(((i, ids, library.decode(ids)) for i, ids in rows), key=str)


def made(spark, docs, **options):
    encoded = P.encode_pieces(spark.createDataFrame(docs, SCHEMA), MODEL, decode=True, **options)
    return sorted(((r.doc_id, r.ids, r.decoded) for r in encoded.collect()), key=str)


def test_words_add_up_to_the_text(library):
    rng = random.Random(4)
    alphabet = "ab ▁\t\né日\U0001F600.'1"
    for text in [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]:
        words = P.marked_words(library.normalize(text))
        assert [i for ids in P.word_ids(library, words) for i in ids] == library.encode(text)


def test_odd_texts_repeats_and_null_ids(spark, library):
    docs = list(enumerate(ODD)) + [(None, "a b"), (None, None), (3, "other"), (3, "other")]
    assert made(spark, docs) == expected(library, docs)


def test_small_batches_and_buckets(spark, library):
    docs = list(enumerate(ODD * 5))
    assert made(spark, docs, batch_chars=50, bucket_bytes=10) == expected(library, docs)


def test_a_very_long_text(spark, library):
    docs = [(1, "one two  three\n" * 100_000), (2, "x")]
    assert made(spark, docs) == expected(library, docs)


def test_whole_query_against_the_library(spark, star, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{star}/documents.parquet").collect()]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = [(i, len(ids), sha(" ".join(map(str, ids))), sha(text)) for i, ids, text in expected(library, docs)]
    assert sorted(map(tuple, op12_sentencepiece(spark, star).collect())) == sorted(wanted)


def test_empty_table_extra_columns_and_no_end(spark, library):
    assert made(spark, []) == []
    frame = spark.createDataFrame([(1, "a b", 5, [1], "w")], SCHEMA + ", batch int, ids array<int>, words string")
    assert P.encode_pieces(frame, MODEL, add_end=False).first().ids == library.encode("a b")


def test_documents_in_another_order_are_noticed():
    batch = P.pd.DataFrame({"sum": [1], "ids": [[1]], "counts": [[1]], "codes": [b""]})
    with pytest.raises(RuntimeError, match="another order"):
        P._laid_out(batch, P.pd.DataFrame({"sum": [2], "bucket": [0], "lengths": [b""], "pieces": [b""]}), [])


def test_decode_replaces_its_column_and_keeps_others(spark, library):
    frame = spark.createDataFrame([(1, [28705, 3], "old"), (2, None, "old")], "n int, ids array<int>, decoded string")
    found = sorted(map(tuple, P.decode_pieces(frame, MODEL).select("n", "decoded").collect()))
    assert found == [(1, library.decode([28705, 3])), (2, None)]


def test_models_with_pieces_across_markers_are_refused():
    class Crossing:
        def get_piece_size(self): return 1
        def is_control(self, i): return False
        is_unknown = is_byte = is_control
        def id_to_piece(self, i): return "▁a▁b"

    with pytest.raises(ValueError, match="marker"):
        P.check_model(Crossing())
