import hashlib
from collections import Counter

import numpy as np
import pytest

from clickweave.llm import token_align
from clickweave.llm.queries import tokenizer_path
from clickweave.llm.token_align import Aligner, ByteLevel, align_tokens, byte_of_char

from .helpers import AWKWARD, awkward, empty

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a▁b", "tab\tand\x00zero", "<s> </s> <unk> <0x41> <|endoftext|>", "  two  blanks ", " ", "\n", "﷽ é ​ x", "😀" * 50]


def paths():
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths()[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=paths()[1])


def brute_force(tools, rows):
    a, b = tools
    to_byte, name = byte_of_char(), {i: t for t, i in a.get_vocab().items()}
    docs = []
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(map(to_byte.__getitem__, name[i])) for i in ids_a]
        pieces = [(i, b.id_to_piece(i)) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            ids_a = ids_b = bytes_a = bytes_b = []
        links, groups, i, j, end_a, end_b = [], [([], [])], 0, 0, 0, 0
        if ids_a:
            end_a, end_b = len(bytes_a[0]), len(bytes_b[0])
        while i < len(ids_a):
            links.append((ids_a[i], ids_b[j]))
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a:
                groups[-1][0].append(str(ids_a[i]))
                i += 1
            if step_b:
                groups[-1][1].append(str(ids_b[j]))
                j += 1
            if step_a and step_b and i < len(ids_a):
                groups.append(([], []))
            end_a += len(bytes_a[i]) if step_a and i < len(ids_a) else 0
            end_b += len(bytes_b[j]) if step_b and j < len(ids_b) else 0
        shown = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if ids_a else ""
        docs.append((doc_id, len(ids_a), len(ids_b), len(groups) if ids_a else 0, links, digest))
    counts = Counter(x for d in docs for x in d[4])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = [(d[0], d[1], d[2], d[3], len(d[4]), sum(counts[x] == most[x[1]] for x in d[4]), sum(counts[x] for x in d[4]), d[5]) for d in docs]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


@pytest.mark.parametrize("sent_pairs", [1_000_000, 300, 0])
def test_awkward_rows_equal_brute_force(spark, tools, sent_pairs, monkeypatch):
    monkeypatch.setattr(token_align, "CHUNK", 150)
    monkeypatch.setattr(token_align, "HELD_PAIRS", 40)
    monkeypatch.setattr(token_align, "PIECE", 7)
    rows = [(r[0], r[1]) for r in AWKWARD] + [(100 + i, t) for i, t in enumerate(ODD)] + [(200, ODD[0] + "" + "x " * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as `row`", "2 as n_a", "'z' as link_a", "3 as n")
    assert found(align_tokens(docs, *paths(), sent_pairs=sent_pairs)) == brute_force(tools, rows)


def test_whole_table_equals_brute_force(spark, tools):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(align_tokens(docs, *paths())) == brute_force(tools, rows)


def test_empty_table_and_texts_without_tokens(spark):
    assert align_tokens(empty(spark), *paths()).count() == 0
    docs = awkward(spark).filter("text is null or text = ''")
    for r in align_tokens(docs, *paths()).collect():
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (0, 0, 0, 0, 0, 0, "")


def test_very_long_text(tools):
    text = "don't stop, it's 3.14 o'clock! 数据 " * 30_000
    found = Aligner(*paths()).align([None, text, "x"])
    assert list(found["n_a"][[0, 2]]) == [0, 1]
    assert found["n_links"][1] == found["n_a"][1] + found["n_b"][1] - found["n_groups"][1]


def test_ranks_equal_the_tokenizer(tools):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    level = ByteLevel(paths()[0])
    assert level.ranks is not None

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(max_size=60), st.text(alphabet="aAzZ éÉçß'’.,-!?%$09<|>\t\n\x0b\xa0 endoftxst", max_size=60)))
    def same(text):
        ids, counts = level.encode([text, ""])
        assert ids.tolist() == tools[0].encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids), 0]

    same()


def test_another_cut_takes_the_tokenizer_itself(tmp_dir):
    import json

    with open(paths()[0], encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with open(f"{tmp_dir}/other.json", "w", encoding="utf-8") as f:
        json.dump(spec, f)
    level = ByteLevel(f"{tmp_dir}/other.json")
    assert level.ranks is None
    ids, counts = level.encode(["a b", " a b"])
    assert counts.tolist() == [2, 2] and np.array_equal(ids[:2], ids[2:])
