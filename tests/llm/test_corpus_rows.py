"""Operators that give rows of single documents: shards, statistics, counts, pieces, segmentations."""

import collections
import itertools
import json
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus_fixtures import documents, nothing, texts  # noqa: F401  (fixtures)
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from sluiceway.llm import packing, quality, sentencepiece_sampling, sharding, token_counts, trees

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_shards(documents, texts, nothing):
    rows = sharding.shard_manifest(documents, "doc_id", "text", [1.0] * 5, block_rows=4).collect()
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == collections.Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    for shard in range(5):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 5) for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sharding.shard_manifest(nothing, "doc_id", "text", [1.0, 2.0]).collect() == []


def test_weights_and_growth(spark):
    keys = spark.range(20_000)
    count = lambda weights: [
        r["count"] for r in sharding.with_shard(keys, "id", weights).groupBy("shard").count().orderBy("shard").collect()
    ]
    few = count([1.0, 1.0, 2.0])
    assert abs(few[2] - 10_000) < 400 and abs(few[0] - 5_000) < 400
    moved = (
        sharding.with_shard(sharding.with_shard(keys, "id", [1.0] * 9, "a"), "id", [1.0] * 10, "b").where("a <> b").collect()
    )
    assert {r.b for r in moved} == {9} and abs(len(moved) - 2_000) < 250


def plain_statistics(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)]


@settings(max_examples=200, deadline=None)
@given(st.text("ab# \n\t\x1c<漢", max_size=120))
def test_statistics(text):
    assert quality.statistics(text)[0] == plain_statistics(text)


def test_quality_rules(spark, documents, texts, nothing):
    labels = spark.createDataFrame([(13, 1), (14, None), (None, 1), (999, 0)], "doc_id long, quality int")
    rows = quality.quality(documents, labels, keep=["doc_id", "shard"]).collect()
    assert len(rows) == len(texts)
    for row in rows:
        counts = plain_statistics(texts[row.shard][1])
        assert [row[c] for c in quality.COUNTS] == counts
        assert row.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert row.kept == (not row.base_failed)  # labels of one kind: nothing to learn from
    assert quality.quality(nothing, labels).collect() == []


def test_trees_learn_and_are_monotonic():
    draw = np.random.default_rng(1)
    rows = draw.random((4000, 4))
    good = ((rows[:, 0] < 0.5) & (rows[:, 1] > 0.3)).astype(float)
    noisy = np.where(draw.random(4000) < 0.05, 1 - good, good)
    forest = trees.fit(rows[:3000], noisy[:3000], np.array([-1, 1, 0, 0]))
    held_out = forest.probability(rows[3000:]) > 0.5
    assert (held_out == (good[3000:] > 0.5)).mean() > 0.97
    for feature, sign in ((0, -1), (1, 1)):
        grid = np.repeat(rows[:50], 40, axis=0)
        grid[:, feature] = np.tile(np.linspace(-1, 2, 40), 50)
        steps = np.diff(forest.margin(grid).reshape(50, 40), axis=1) * sign
        assert steps.min() >= -1e-9
    for one_kind in (np.ones(5), np.zeros(0)):
        assert trees.fit(rows[: len(one_kind)], one_kind, np.zeros(4)).probability(rows[:3]).shape == (3,)


def test_held_out_labels(spark, sf):
    documents, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    judged = quality.quality(documents, labels.where(half == 0)).join(labels.where(half == 1), "doc_id").where("NOT base_failed")
    rows = judged.select("kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.95


def library():
    tokenizer = Tokenizer.from_file(BPE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_token_counts(documents, texts, nothing):
    ids = library()
    rows = token_counts.token_counts(documents, BPE, 100).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == collections.Counter(
        (i, len((t or "").encode()), n := len(ids(t)), n > 100) for i, t in texts
    )
    assert token_counts.token_counts(nothing, BPE, 100).collect() == []


def test_token_counts_of_odd_texts():
    ids, counts, draw = library(), token_counts.counts_for(BPE), random.Random(2)
    odd = [
        "Σ", "ΑΣ", "é", "́", "İ", "<|endoftext|>", "<|ENDOFTEXT|>", " ", "\n", "\x1c", "\x85", "\xa0", "'s", "'LL", "12",
        "½", "漢", "😀", "ß", "ﬁ", "​", "\x00", "!--", "ǅ", "the", "inging", "하",
    ]
    for _ in range(3000):
        text = "".join(draw.choice(odd) for _ in range(draw.randint(0, 12)))
        assert counts.of(text.encode()) == len(ids(text)), repr(text)


def test_unknown_vocabulary(tmp_path):
    spec = json.load(open(BPE)) | {"pre_tokenizer": {"pretokenizers": [{"type": "Other"}, {"type": "ByteLevel"}]}}
    (tmp_path / "other.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_counts.PairMerger(str(tmp_path / "other.json"))


def test_packing(documents, texts, nothing):
    ids = library()
    rows = packing.pack(documents, BPE, size=128, group_rows=1000).collect()
    all_ids = collections.defaultdict(list)
    for i, t in texts:
        all_ids[i].append(np.array([*ids(t), 0], "<u4"))
    expected = collections.Counter(
        (i, n, start, len(x[start : start + 128]), zlib.crc32(x[start : start + 128].tobytes()))
        for i, several in all_ids.items() for x in several for n, start in enumerate(range(0, len(x), 128))
    )
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 128
    assert len(bins) <= -(-sum(r.length for r in rows) // 128) + 2
    assert packing.pack(nothing, BPE).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_packed_lengths(lengths):
    sizes = np.array(lengths, np.int64)
    bins = packing.pack_lengths(sizes, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sizes[b].sum() <= 20 for b in bins)
    assert len(bins) <= len(packing.best_fit(sizes, 20))


def test_word_ids_of_odd_texts():
    """Letters whose small form alone composes with a mark, and other odd ones, as the library sees them."""
    ids, words, draw = library(), packing.WordIds(BPE), random.Random(4)
    odd = [
        "J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "A\u030a", "\u03a3", "\u0130", "I\u0307", "<|endoftext|>",
        "<|ENDOFTEXT|>", " ", "\n", "\x1c", "\x85", "\xa0", "'s", "'LL", "12", ",", ".", "\u00bd", "\u6f22", "\u212b", "A", "the",
    ]
    for text in ["J\u030c", *("".join(draw.choices(odd, k=draw.randint(0, 12))) for _ in range(3000))]:
        assert np.frombuffer(next(words.of([text.encode()])), "<u4").tolist() == ids(text), repr(text)


def test_a_part_of_words_is_encoded_once():
    """Words that differ in capitals or in signs around them share what the library is asked for."""
    ids, words = library(), packing.WordIds(BPE)
    text = "Élan, élan. ÉLAN; élan### élan's (élan) élan\xa0élan 漢élan, élan"
    assert np.frombuffer(next(words.of([text.encode()])), "<u4").tolist() == ids(text)
    assert {word for word in words.known if "lan" in str(word)} == {"élan", "漢élan,"}


def test_swaps_empty_a_bin():
    # two for one: 4 and 3 go for a 6
    sizes = np.array([6, 3, 4, 3, 3])
    found = packing.SwapSearch(sizes, [[0, 1], [2, 3], [4]], 10).run()
    assert len(found) == 2 and sorted(i for b in found for i in b) == [0, 1, 2, 3, 4]


def test_sampled_segmentations(documents, texts, nothing):
    rows = sentencepiece_sampling.sampled_segmentations(documents, PIECES, 3, with_ids=True).collect()
    again = sentencepiece_sampling.sampled_segmentations(documents.repartition(7), PIECES, 3, with_ids=True).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    processor = sentencepiece_sampling.Vocabulary(PIECES).processor
    by_id = dict(texts)
    for r in rows:
        text = by_id[r.doc_id] or ""
        assert r.round_trip == ("▁" not in text)
        if r.round_trip:
            assert processor.decode(r.ids) == text
        assert r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.log_prob <= 0 and r.log_inclusion <= 0
    samples = collections.defaultdict(set)
    for r in rows:
        samples[r.doc_id].add(tuple(r.ids))
    assert all(len(s) == 3 for i, s in samples.items() if len(by_id[i] or "") > 5) and samples[5] == samples[6] == {()}
    assert sentencepiece_sampling.sampled_segmentations(nothing, PIECES, 2).collect() == []


def test_paths_keep_what_they_have_in_common():
    """Later paths take over the steps before the one they part at; ranges are told by places of four bytes."""
    lattices = sentencepiece_sampling.Lattices(sentencepiece_sampling.Vocabulary(PIECES))
    units = lattices.vocabulary.units("the whole of it, once more and ünd 漢字 again " * 5)
    lattices.learn(units)
    edges = lattices.edges
    for seed in range(30):
        for path in sentencepiece_sampling.Sampler(lattices, units, np.random.default_rng(seed)).sample(5)[0]:
            assert np.array_equal(path.logs, edges.log_share[path.edges])
            assert np.array_equal(path.before, np.cumsum(path.logs) - path.logs)
            assert math.isclose(path.log_prob, path.logs.sum(), abs_tol=1e-9)
            spelled = b"".join(lattices.texts[n] for n in edges.piece[path.edges].tolist())
            assert spelled.decode() == "".join(units)
    values, sizes = np.arange(200_000, dtype=np.uint8), np.full(100_000, 30)
    begins = np.arange(100_000)
    tracemalloc.start()
    found, ends = sentencepiece_sampling.spans(values, begins, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[ends[77] : ends[78]].tolist() == values[77:107].tolist() and len(found) == ends[-1] == 3_000_000
    assert peak < 40_000_000  # places of eight bytes take 24,000,000 twice
    assert sentencepiece_sampling.spans(values, begins[5:9], np.ones(4, int))[0].tolist() == [5, 6, 7, 8]


def test_samples_follow_the_law():
    lattices = sentencepiece_sampling.Lattices(sentencepiece_sampling.Vocabulary(PIECES))
    weight, last = lattices.vocabulary.weight, lattices.vocabulary.last
    marked, law = "▁ab▁ca", {}

    def spell(at, pieces, total):
        if at == len(marked):
            law[tuple(pieces)] = total
        for end in range(at + 1, len(marked) + 1):
            piece = marked[at:end]
            if piece in weight or end == at + 1:
                spell(end, [*pieces, piece], total + weight.get(piece, last))

    spell(0, [], 0.0)
    whole = math.log(sum(map(math.exp, law.values())))
    law = {k: math.exp(w - whole) for k, w in law.items()}
    units = lattices.vocabulary.units("ab ca")
    lattices.learn(units)
    first, second, weights = collections.Counter(), collections.Counter(), collections.Counter()
    for seed in range(6000):
        paths, threshold = sentencepiece_sampling.Sampler(lattices, units, np.random.default_rng(seed)).sample(3)
        found = [tuple(lattices.texts[p].decode() for p in lattices.edges.piece[x.edges]) for x in paths]
        assert len(set(found)) == 3
        for path, key in zip(paths, found, strict=True):
            assert math.isclose(path.log_prob, math.log(law[key]), abs_tol=1e-9)
            weights[key] += 1 / math.exp(sentencepiece_sampling.log_inclusion(path.log_prob, threshold))
        first[found[0]] += 1
        second[found[1]] += 1
    for key, share in law.items():
        after = sum(law[k] * share / (1 - law[k]) for k in law if k != key)
        assert abs(first[key] / 6000 - share) < 0.025 and abs(second[key] / 6000 - after) < 0.025
        if share > 0.01:
            assert abs(weights[key] / 6000 - 1) < 0.25  # inverse inclusion scores are unbiased


def improvements(lengths, bins, size):
    """Moves and exchanges of one or two pieces that would fill a bin at least as full further."""
    fills = [int(lengths[b].sum()) for b in bins]
    for s, t in itertools.permutations([n for n, fill in enumerate(fills) if fill < size], 2):
        if fills[t] < fills[s]:
            continue
        own = sorted(lengths[bins[s]].tolist())
        given = {*own, *(a + b for n, a in enumerate(own) for b in own[n + 1 :])}
        singles, room = set(own), size - fills[t]
        if any(x <= room for x in singles) or any(0 < x - y <= room for y in {*lengths[bins[t]].tolist()} for x in given):
            yield s, t


@pytest.mark.parametrize("seed", range(6))
def test_no_bin_is_left_out_of_the_swaps(seed):
    draw = np.random.default_rng(seed)
    many = [1] * 150 + [3] * 50  # a bin of 200 pieces
    stubborn = [[n] for n in range(1030, 1110)]  # 80 that fit with none of their kind
    rest = [draw.integers(200, 900, 2).tolist() for _ in range(30)] + [[2047], [2046 - seed, 1]]
    bins, lengths = [], []
    for held in [many, *stubborn, *rest]:
        bins.append([*range(len(lengths), len(lengths) + len(held))])
        lengths += held
    lengths = np.array(lengths)
    search = packing.SwapSearch(lengths, bins, 2048)
    before = sum(int(lengths[b].sum()) ** 2 for b in bins)
    packed = search.run()
    assert sorted(i for b in packed for i in b) == list(range(len(lengths)))
    assert max(int(lengths[b].sum()) for b in packed) <= 2048 and len(packed) < len(bins)
    assert sum(int(lengths[b].sum()) ** 2 for b in packed) > before
    assert search.done() or not any(improvements(lengths, packed, 2048))


def test_registered_queries_row_by_row(spark, sf):
    """Statistics, pieces and token counts of the smallest documents, by plain Python and the vocabulary's library."""
    from sluiceway.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    ids = library()
    tokens = {i: [*ids(t), 0] for i, t in texts.items()}

    for row in QUERIES["op2_quality_rules"](spark, sf).collect():
        counts = plain_statistics(texts[row.doc_id])
        assert [row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words] == counts
        assert row.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0]) and not (row.base_failed and row.kept)

    counted = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op10_token_counts"](spark, sf).collect()}
    assert counted == {i: (len((t or "").encode()), len(tokens[i]) - 1, len(tokens[i]) - 1 > 2048) for i, t in texts.items()}

    pieces = QUERIES["op5_best_fit_packing"](spark, sf).collect()
    expected = {
        (i, start // 2048): (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
        for i, own in tokens.items() for start in range(0, len(own), 2048) for part in [own[start : start + 2048]]
    }
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in pieces} == expected and len(pieces) == len(expected)
    fills = collections.defaultdict(list)
    for r in pieces:
        fills[r.sequence_id].append((r.offset, r.length))
    for placed in fills.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(placed))]
        assert [at for at, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 2048
    assert len(fills) <= -(-sum(map(len, tokens.values())) // 2048) + 2


def test_lattices_grow_in_place():
    """New units do not copy what is known of the others, and shares are those of each unit alone."""
    lattices = sentencepiece_sampling.Lattices(sentencepiece_sampling.Vocabulary(PIECES))
    draw = random.Random(8)
    units = list(dict.fromkeys("".join(draw.choices("abeinorst漢#é", k=draw.randint(1, 9))) for _ in range(900)))
    lattices.learn(units[:600])
    held = lattices.edges.upto
    lattices.learn(units[600:700])
    assert lattices.edges.upto is held
    lattices.learn(units[700:])
    alone = sentencepiece_sampling.Lattices(lattices.vocabulary)
    for unit in units[::50]:
        alone.clear()
        alone.learn([unit])
        results = []
        for lattice in (lattices, alone):
            start = lattice.starts[unit]
            low, high = lattice.first[start], lattice.first[start + len(unit)]
            e = lattice.edges
            pieces = [lattice.texts[n].decode() for n in e.piece[low:high]]
            results.append((pieces, e.log_share[low:high].tolist(), (e.upto[low:high] - start).round(6).tolist()))
        assert results[0] == results[1]
        assert {p for p in pieces if len(p) > 1} == {
            unit[i:j] for i in range(len(unit)) for j in range(i + 2, len(unit) + 1) if unit[i:j] in lattices.vocabulary.ids
        }


def test_arrivals_follow_the_law():
    """Paths in the order in which they arrive are those that a draw for every path would have ranked first."""
    lattices = sentencepiece_sampling.Lattices(sentencepiece_sampling.Vocabulary(PIECES))
    texts, weight = ["ab ca"] * 6000, lattices.vocabulary.weight
    names, kinds, sizes = lattices.vocabulary.units_of(texts)
    rows = lattices.rows(names)
    assert not sentencepiece_sampling.Arrivals.fits(lattices, rows, kinds, sizes, 3).any()  # so that paths come twice here
    seeds = np.arange(6000).astype(np.uint64)
    found = sentencepiece_sampling.Arrivals(lattices, names, rows, kinds, sizes, seeds).samples(3)
    law, numbers = {}, lattices.vocabulary.ids
    for cuts in itertools.product([False, True], repeat=5):
        parts = "".join(c + "|" * cut for c, cut in zip("▁ab▁ca", [*cuts, False], strict=True)).split("|")
        if all(p in numbers for p in parts) and not any("▁" in p[1:] for p in parts):
            law[np.array([numbers[p] for p in parts], "<u4").tobytes()] = sum(weight[p] for p in parts)
    whole = math.log(sum(map(math.exp, law.values())))
    law = {k: math.exp(w - whole) for k, w in law.items()}
    first, second, scores = collections.Counter(), collections.Counter(), collections.Counter()
    gumbel = []
    for paths, threshold in found:
        assert len({p.ids for p in paths}) == 3 and all(p.spelt for p in paths)
        assert [p.perturbed for p in paths] == sorted([p.perturbed for p in paths], reverse=True)
        assert threshold < paths[-1].perturbed
        gumbel.append(paths[0].perturbed)
        first[paths[0].ids] += 1
        second[paths[1].ids] += 1
        for p in paths:
            assert math.isclose(p.log_prob, math.log(law[p.ids]), abs_tol=1e-9)
            scores[p.ids] += 1 / math.exp(sentencepiece_sampling.log_inclusion(p.log_prob, threshold))
    assert abs(np.mean(gumbel) - 0.5772) < 0.08 and abs(np.var(gumbel) - math.pi**2 / 6) < 0.2
    for key, share in law.items():
        after = sum(law[k] * share / (1 - law[k]) for k in law if k != key)
        assert abs(first[key] / 6000 - share) < 0.025 and abs(second[key] / 6000 - after) < 0.025
        if share > 0.01:
            assert abs(scores[key] / 6000 - 1) < 0.25


def test_only_units_that_leave_their_likely_path_are_walked(monkeypatch):
    """Walks of all units, two and a half times a text, took most of the time."""
    walked = [0]

    def counted(walk):
        def call(self, *arrays):
            walked[0] += len(arrays[0])
            return walk(self, *arrays)

        return call

    for name in ("Batch", "Arrivals"):
        if kind := getattr(sentencepiece_sampling, name, None):
            monkeypatch.setattr(kind, "walk", counted(kind.walk))
    model = sentencepiece_sampling.lattices_for(PIECES).vocabulary
    text = "the people of this city have been there for more than a year and 漢 know it\n" * 40
    units = len(model.units(text))

    class Frame:
        schema = StructType().add("doc_id", "long")

        def select(self, *names):
            return self

        def mapInArrow(self, work, schema):
            return list(work(iter([pa.RecordBatch.from_pydict({"doc_id": [5, 6], "text": [text, text + "▁"]})])))

    rows = sentencepiece_sampling.sampled_segmentations(Frame(), PIECES, 4, with_ids=True)[0].to_pylist()
    assert 0 < walked[0] < 2 * units
    assert [r["round_trip"] for r in rows] == [True] * 4 + [False] * 4
    assert len({tuple(r["ids"]) for r in rows}) == 8
    last = model.last
    plain = {i: model.weight[p] for p, i in model.ids.items()}
    sums = [r["log_prob"] - sum(plain.get(i, last) for i in r["ids"]) for r in rows]
    assert max(sums[:4]) - min(sums[:4]) < 1e-6  # the same mass of all paths
    assert all(model.processor.decode(r["ids"]) == text for r in rows[:4])


def test_units_of_many_texts():
    lattices = sentencepiece_sampling.Lattices(sentencepiece_sampling.Vocabulary(PIECES))
    draw = random.Random(3)
    inside = {a + b for piece in lattices.vocabulary.ids for a, b in itertools.pairwise(piece)}
    assert lattices.vocabulary.units("ab, é") == ["▁ab", ",", "▁é"]
    some = ["", " ", "  ", "▁", "a", *("".join(draw.choices("ab  ▁\n漢é", k=draw.randint(0, 12))) for _ in range(300)), ""]
    for texts in (some, [], [""], ["", ""]):
        names, kinds, sizes = lattices.vocabulary.units_of(texts)
        rows, again = lattices.rows(names), lattices.rows(names[::-1])
        names, ends = names.to_pylist(), np.cumsum(sizes)
        units = [[names[k] for k in kinds[e - s : e]] for e, s in zip(ends, sizes, strict=True)]
        assert units == [lattices.vocabulary.units(t) for t in texts]
        assert ["".join(u) for u in units] == ["▁" + t.replace(" ", "▁") if t else "" for t in texts]
        assert not {a[-1] + b[0] for u in units for a, b in itertools.pairwise(u)} & inside  # no piece reaches across
        assert rows.tolist() == again.tolist()[::-1]
        assert lattices.paths.start[rows].tolist() == [lattices.starts[u] for u in names]
        for n in rows.tolist():
            path = lattices.paths
            assert math.isclose(lattices.leave[path.start[n]], -math.expm1(path.log_prob[n]), abs_tol=1e-12)
        assert lattices.paths.spelt[rows].all()
    letters, cuts = np.frombuffer(b"abcabd", np.uint8), np.array([0, 3, 6])
    alike = sentencepiece_sampling.alike
    assert alike(letters, cuts, letters, cuts).tolist() == [True, True]
    assert alike(letters, cuts, np.frombuffer(b"abcabc", np.uint8), cuts).tolist() == [True, False]
    assert alike(letters, cuts, letters, np.array([0, 2, 6])).tolist() == [False, False]
