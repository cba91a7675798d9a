import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers.decoders import ByteLevel

from foldwise.llm import pieces, token_counts


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The vocabulary with its scores as a unigram model; blocked pieces are as bad as the worst ones."""
    model = proto.ModelProto()
    with open(pieces.DEFAULT_MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0) / 1000
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_model_fields():
    model = pieces.load_model(pieces.DEFAULT_MODEL)
    wanted = proto.ModelProto()
    with open(pieces.DEFAULT_MODEL, "rb") as file:
        wanted.ParseFromString(file.read())
    assert model.pieces == [p.piece for p in wanted.pieces] and model.scores == [p.score for p in wanted.pieces]
    assert model.kinds == [p.type for p in wanted.pieces] and model.byte_fallback and model.add_dummy_prefix
    assert model.model_type == pieces.BPE and not model.remove_extra_whitespaces and model.splits_at_marks


def test_parity_and_round_trip(documents, nothing):
    check = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    coded = pieces.encode(documents, "text")
    rows = pieces.decode(coded, "token_ids", "back").collect()
    assert len(rows) == documents.count()
    for r in rows:
        if r.text is None:
            assert r.token_ids is None and r.n_tokens == 0 and r.back is None and r.parity is None and r.round_trip is None
        else:
            assert r.token_ids == check.encode(r.text) and r.n_tokens == len(r.token_ids)
            assert r.parity and r.round_trip and r.back == r.text
    assert pieces.encode(nothing, "text").count() == 0 and pieces.decode(pieces.encode(nothing, "text")).count() == 0


def test_faults_of_the_backend_show(monkeypatch):
    """Ids come from the rebuilt tokenizer, so a wrong merge table or decoder turns a flag false."""
    texts = ["some words of a text", "other words", ""]
    right = pieces.Codec(pieces.DEFAULT_MODEL).encode(texts)[0].tolist()
    monkeypatch.setattr(pieces, "PROBES", ())
    merges = pieces._merges
    monkeypatch.setattr(pieces, "_merges", lambda model: merges(model)[5_000:])
    codec = pieces.Codec(pieces.DEFAULT_MODEL)
    ids, _, parity, trip = codec.encode(texts)
    assert ids.tolist() != right and parity.tolist() == [False, False, True] and trip.all()
    monkeypatch.setattr(pieces, "_merges", merges)
    codec = pieces.Codec(pieces.DEFAULT_MODEL)
    codec.tokenizer = pieces.build_tokenizer(codec.model)
    codec.tokenizer.decoder = ByteLevel()
    ids, _, parity, trip = codec.encode(texts)
    assert ids.tolist() == right and parity.all() and trip.tolist() == [False, False, True]


def test_unigram_models(unigram, texts):
    codec = pieces.Codec(unigram)
    some = [t or "" for t in texts if len(t or "") < 2000]
    ids, sizes, parity, trip = codec.encode(some)
    ends = np.cumsum(sizes)
    check = sentencepiece.SentencePieceProcessor(model_file=unigram)
    assert all(ids[e - s:e].tolist() == check.encode(t) for e, s, t in zip(ends, sizes, some))
    assert trip.all()
    codec.by_unit = False
    whole = codec.encode(some)
    assert whole[0].tolist() == ids.tolist() and whole[3].all()


def test_forgetting_units_changes_nothing(texts, monkeypatch):
    codec = pieces.Codec(pieces.DEFAULT_MODEL)
    some = [t or "" for t in texts]
    whole = codec.encode(some)[0].tolist()
    monkeypatch.setattr(pieces, "KNOWN_UNITS", 1)
    assert codec.encode(some)[0].tolist() == whole and codec.encode(some[:3])[1].tolist() == [len(codec.check.encode(t)) for t in some[:3]]


class Counted:
    """A tokenizer that notes what it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, units, **options):
        self.given += units
        return self.tokenizer.encode_batch_fast(units, **options)


def test_words_are_encoded_in_rows():
    """Each distinct word once, in a row with others; only units with other marks are encoded one by one."""
    codec = pieces.Codec(pieces.DEFAULT_MODEL)
    codec.bare = Counted(codec.bare)
    words = [f"word{i}, übergröße{i}\n" for i in range(700)]
    some = ["", " ".join(words), " ".join(words[::-1]), "", "a  b ", "", " ", "▁a b", "\x00 \t"]
    ids, sizes, parity, trip = codec.encode(some)
    assert sorted(codec.bare.given) == ["▁", "▁▁", "▁▁a", "▁▁b"] and parity.all() and trip.all()
    ends = np.cumsum(sizes)
    assert [ids[e - s:e].tolist() for e, s in zip(ends, sizes)] == [codec.check.encode(t) for t in some]
    assert [x.tolist() for x in codec.encode(["", ""])] == [[], [0, 0], [True, True], [True, True]]


def test_rows_that_do_not_show_their_units(texts):
    """Where the ids of a row cannot be dealt to its units, the units are encoded one by one."""
    some = [t or "" for t in texts]
    codec, other = pieces.Codec(pieces.DEFAULT_MODEL), pieces.Codec(pieces.DEFAULT_MODEL)
    other.opens[:] = False
    other.bare = Counted(other.bare)
    assert [x.tolist() for x in other.encode(some)] == [x.tolist() for x in codec.encode(some)]
    assert set(other.bare.given) == {u for t in some if t for u in pieces.UNIT.findall(other.normal(t))}


def test_bad_ids(spark):
    rows = spark.createDataFrame([([1_000_000],)], "token_ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        pieces.decode(rows).collect()


def test_counts_are_those_of_the_best_segmentation(unigram, texts):
    counter = token_counts.TrieCounter(pieces.load_model(unigram))
    check = sentencepiece.SentencePieceProcessor(model_file=unigram)
    words = sorted({w for t in texts for w in (t or "").replace("\n", " ").split(" ") if w and len(w) < 100})
    assert counter.count([pieces.MARK + w for w in words]) == [len(check.encode(w)) for w in words]


def brute(unit, scores, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(unit) + 1):
        ways = [(best[b][0] + scores[unit[b:end]], best[b][1] + 1) for b in range(max(0, end - 20), end) if unit[b:end] in scores]
        if unit[end - 1] not in scores:
            ways.append((best[end - 1][0] + unknown, best[end - 1][1] + len(unit[end - 1].encode())))
        best.append(max(ways, key=lambda w: w[0]))
    return best[-1]


def test_shared_prefixes_give_what_single_words_give(texts):
    model = pieces.load_model(pieces.DEFAULT_MODEL)
    shared = token_counts.TrieCounter(model)
    units = sorted({u for t in texts for u in pieces.UNIT.findall(pieces.MARK + (t or "").replace(" ", pieces.MARK)) if len(u) < 200})
    shared.learn(units)
    for unit in units:
        alone = token_counts.TrieCounter(model)
        alone.learn([unit])
        assert alone.counts[unit] == shared.counts[unit] == brute(unit, shared.scores, shared.unknown)[1]


def test_count_tokens(documents, nothing):
    got = token_counts.count_tokens(documents, "text").select("text", "n_tokens").collect()
    assert all((r.n_tokens is None) == (r.text is None) for r in got)
    assert all(r.n_tokens == 0 for r in got if r.text == "") and any(r.n_tokens > 6_000 for r in got if r.text)
    again = token_counts.count_tokens(documents.repartition(1).orderBy(F.desc("text")), "text")
    assert sorted(map(str, again.select("text", "n_tokens").collect())) == sorted(map(str, got))
    assert token_counts.count_tokens(nothing, "text").count() == 0
