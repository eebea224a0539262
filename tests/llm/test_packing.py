import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quire.llm import packing
from tests.llm.data import documents, empty, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def reference_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_added_tokens_are_the_plain_tokenizer_s():
    ids = array("I", packing.WordTokenizer(PATH).id_bytes("hello <|endoftext|> world")).tolist()
    assert ids == [3306, 49407, 1002]


def test_word_ids_equal_the_tokenizer_s():
    own = packing.WordTokenizer(PATH)
    odd = ["aZ09'sll \t\n\x85\xa0ÀÿßµªºÆ×÷²½", "don't WE'VE 'tis it''s x'm'll", "A\x00B\x1c\x1dC", "ΑΣ Σ ς İ", "é é", "100%$$$***&&&", "‘q’—…", "hello <|endoftext|> world", "a<|startoftext|>b<|STARTOFTEXT|>", "<|endoftext|>", "<| endoftext|>"]
    for t in [*odd, *[x or "" for x in texts(60)]]:
        assert own.id_bytes(t) == array("I", reference_ids(t)).tobytes()


def test_every_id_in_one_piece_and_no_gaps(spark):
    rows, docs = documents(spark)
    capacity = 256
    got = packing.pack(docs, PATH, capacity).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = [*reference_ids(text), 2]
        for at in range(0, len(ids), capacity):
            piece = array("I", ids[at : at + capacity])
            want[doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert want == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_longest_first_into_the_shortest_pack():
    groups = packing.pack_histogram({7: 1, 5: 2, 3: 3, 1: 1}, 10)
    packs = []
    for count, p in groups:
        lengths = []
        while p is not None:
            p, n = p
            lengths.append(n)
        packs += [tuple(reversed(lengths))] * count
    # 7 leaves 3; 5 opens a pack and the next 5 joins it; a 3 joins the 7, the others open a pack, where 1 goes
    assert sorted(packs) == [(3, 3, 1), (5, 5), (7, 3)]
    assert sum(len(p) for p in packs) == 7


def test_equal_short_lengths_share_packs():
    assert sum(c for c, _ in packing.pack_histogram({10: 1000}, 4096)) == 3


def test_counts_move_together():
    groups = packing.pack_histogram({3000: 10**9, 1096: 10**9 + 5}, 4096)
    assert sum(c for c, _ in groups) == 10**9 + 2
    assert len(packing.slot_table(groups)["first"]) < 10


def test_empty(spark):
    assert packing.pack(empty(spark), PATH).collect() == []


@pytest.mark.parametrize("seed", [3, 4])
def test_little_padding(spark, seed):
    _, docs = documents(spark, 400, seed)
    got = packing.pack(docs, PATH, 1024).collect()
    used = sum(r["length"] for r in got)
    assert used / (1024 * len({r["sequence_id"] for r in got})) > 0.97
