"""What a worker holds and does again."""

import pickle

import cases
import pyarrow as pa
from pyspark.sql import functions as F

from filmgrain.llm import pieces, pii


def test_stretches_of_earlier_batches_are_not_read_again(monkeypatch):
    vocabulary = pieces.read_vocabulary()
    own, read = pieces.Codec(vocabulary), []
    best = own.best
    monkeypatch.setattr(own, "best", lambda some: read.extend(some) or best(some))
    texts = [cases.words(200, s) for s in (1, 2)] + ["", " a  b ", "x" * 100 + " ünï 漢字 x"]
    first = own.encode_all(texts)
    assert read and all(len(s) <= pieces.LONGEST for s in own.kept)
    read.clear()
    again = own.encode_all(texts)
    assert read == ["x" * 100]
    for a, b, t in zip(first, again, texts):
        assert a.tolist() == b.tolist() == pieces.Codec(vocabulary).encode(t).tolist()


def test_kept_stretches_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 10)
    own = pieces.Codec(pieces.read_vocabulary())
    for seed in range(4):
        text = cases.words(50, seed)
        assert own.decode(own.encode(text)) == text
        assert len(own.kept) <= 10


def test_personal_data_does_not_depend_on_what_is_decoded_together(monkeypatch):
    assert pii.PIECE <= 1 << 18
    field = pii.train([(0, 0, "call", "O"), (0, 1, "555-123-4567", "phone"), (1, 0, "no", "O"), (1, 1, "word", "O")])
    texts = ["call 555-123-4567 now", None, "", "no word\ncall 415-555-2671", "a@b.cd"] * 3
    together = pii.find_all(texts, field)
    monkeypatch.setattr(pii, "PIECE", 1)
    assert pii.find_all(texts, field) == together


def test_workers_drop_the_codec_with_its_broadcast(spark):
    shared = pieces.Shared(pieces.Vocabulary(((0, "a", -1.0), (1, " ", -1.0)), None, 2, 3))
    assert shared.codec is shared.codec
    assert "codec" not in vars(pickle.loads(pickle.dumps(shared)))  # what is sent is the vocabulary
    docs = spark.range(0, 64, 1, 32).selectExpr("repeat('a ', int(id)) AS text")
    docs.select(pieces.encode(spark, shared.vocabulary, F.col("text"))).collect()
    other = spark.sparkContext.broadcast("other work")

    @F.arrow_udf("int")
    def left(ids):
        import gc

        assert other.value
        return pa.array([sum(type(x).__name__ == "Codec" for x in gc.get_objects())] * len(ids), pa.int32())

    assert {r[0] for r in spark.range(0, 64, 1, 32).select(left("id")).collect()} == {0}
