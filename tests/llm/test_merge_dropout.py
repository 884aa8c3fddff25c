import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from voicetide.llm import merge_dropout as md
from voicetide.llm import vocab

PATH = vocab.default_pieces()


@pytest.fixture(scope="module")
def plain():
    return md.Encoder(vocab.pieces(PATH), 0.0, 0)


@pytest.fixture(scope="module")
def dropping():
    return md.Encoder(vocab.pieces(PATH), 0.3, 5)


def ids(packed):
    return np.frombuffer(packed, "<i4").tolist()


def brute(encoder, word, variant):
    """The agenda without an agenda: the best pair not skipped yet, step by step."""
    symbols = [(c, i) for i, c in enumerate(word)]
    skipped, number = set(), 0
    text = vocab.pieces(PATH)
    while True:
        options = []
        for (a, i), (b, j) in zip(symbols, symbols[1:], strict=False):
            piece = text.ids.get(a + b)
            if a in text.ids and b in text.ids and piece is not None and (i, a, b) not in skipped:
                options.append((-text.score[piece], i, j, a, b))
        if not options:
            return [x for a, _ in symbols for x in ([text.ids[a]] if a in text.ids else encoder.spell(a))]
        _, i, j, a, b = min(options)
        if variant is not None and bool(encoder.decide(np.array([variant]), np.array([number]))[0]):
            skipped.add((i, a, b))
        else:
            at = symbols.index((a, i))
            symbols[at : at + 2] = [(a + b, i)]
        number += 1


def test_without_dropout_it_is_the_models_own(documents, plain):
    texts = [r.text for r in documents.select("text").limit(60).collect()]
    texts += ["", " ", "  two  spaces ", "new\nlines\n\n", "日本語 \U0001f600", "tab\t<s> <unk> <0x41>"]
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert [ids(p) for p in plain.encode(texts, [0] * len(texts))] == model.encode(texts)


@pytest.mark.parametrize("word", ["▁the", "▁internationalisation", "▁▁▁re", "▁x9é\U0001f600tion", "▁" + "then" * 12])
def test_steps_heap_and_brute_force_agree(word, dropping):
    for variant in (0, 1, 17, 900):
        packed, up = dropping.encode_words([word], np.array([variant]))
        assert ids(packed[0]) == brute(dropping, word, variant)
        assert dropping.one(word, variant) == (packed[0], int(up[0]))


def test_seeds_and_keys_vary_the_pieces_and_never_the_text(documents, dropping):
    texts = [r.text for r in documents.select("text").limit(20).collect()]
    texts += ["a▁b ▁ ▁▁", "\udfffx".encode("utf-8", "replace").decode(), " ", "x" * 5000]
    first = dropping.encode(texts, list(range(len(texts))))
    assert first == dropping.encode(texts, list(range(len(texts))))
    assert first != dropping.encode(texts, [k + 99 for k in range(len(texts))])
    assert first != md.Encoder(vocab.pieces(PATH), 0.3, 6).encode(texts, list(range(len(texts))))
    assert [dropping.decode(ids(p)) for p in first] == texts


def test_share_of_skipped_candidates(dropping):
    assert abs(dropping.skips.mean() - 0.3) < 0.01


def test_cases(edge, nothing):
    rows = md.decode(md.encode(edge, ["doc_id", "text"]), ["doc_id", "text", "pieces"]).collect()
    assert len(rows) == edge.count()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert {len(r.pieces) for r in rows if not r.text} == {0}
    same = [r.pieces for r in rows if r.doc_id == 1 and r.text == rows[0].text]
    assert len(same) == 2 and same[0] == same[1]
    empty = md.decode(md.encode(nothing, ["doc_id"]), ["doc_id"])
    assert empty.count() == 0 and empty.columns == ["doc_id", "decoded"]


def test_partitioning_does_not_matter(documents):
    def run(n):
        found = md.encode(documents.repartition(n), ["doc_id"])
        return found.select("doc_id", F.md5(F.col("pieces").cast("string"))).orderBy("doc_id").collect()

    assert run(1) == run(7)
