import pyarrow as pa

from colfit.llm import words


def test_words_are_those_of_bytes_split():
    texts = ["", " a  b\t\n", None, "ab", "ÉT É\x0b\x0cx\x85y\u3000z", "q" * 100 + " " + "q" * 101, "AbC z"]
    for lower in (False, True):
        found = words.split(pa.array(texts), lower)
        plain = [(t or "").encode() for t in texts]
        plain = [(p.lower() if lower else p).split() for p in plain]
        assert [found.word(i) for i in range(len(found.start))] == [w for p in plain for w in p]
        assert found.before.tolist() == [sum(map(len, plain[:i])) for i in range(len(plain) + 1)]


def test_hashes_depend_on_the_word_alone():
    a = words.split(pa.array(["one two", "three " + "x" * 90]))
    b = words.split(pa.array(["three", "x" * 90 + " one", "two", "eno"]))
    known = {a.word(i): h for i, h in enumerate(words.hashes(a).tolist())}
    for i, h in enumerate(words.hashes(b).tolist()):
        assert known.get(b.word(i), h) == h
    assert len(set(words.hashes(b).tolist())) == 5


def test_slices_cover_all(monkeypatch):
    monkeypatch.setattr(words, "BYTES_AT_ONCE", 10)
    texts = pa.array(["abc", None, "", "d" * 30, "ef", "ghi", "jklmnop"])
    assert [t for part in words.slices(texts) for t in part.to_pylist()] == texts.to_pylist()
    assert len(list(words.slices(texts))) > 2
    assert list(words.slices(texts.slice(0, 0))) == []
