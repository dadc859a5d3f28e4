"""The whole pipeline against brute force: shared and missing ids, and columns named like helpers."""

import collections
import random
import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quayside.llm import decontaminate, minhash, queries as llm
from quayside.llm.tokens import vocabulary

#: columns a user may have that operators could use for themselves
EXTRA = ("id long, tie string, lists int, places string, spans string, score double, lang_pred int, n_words string, row string, "
         "key string, at int, gone string, bad string, component_id long, `odd name` string")
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
WORDS = "the of and to in is was that for it with as his on be at by had not are but from or have an they which one you".split()
ITEMS = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my", "short item", None, ""]


def documents():
    r = random.Random(21)
    said = lambda n: " ".join(r.choice(WORDS) + r.choice(["", "", "er", "ing", "é"]) + str(r.randrange(50)) for _ in range(n))
    base, passage = said(120), said(45)
    near = lambda: " ".join(w if r.random() > 0.01 else "edit" for w in base.split())
    rows = [(k, said(r.randint(1, 150)), "en" if k % 4 else "de") for k in range(40)]
    rows += [(60 + k, near(), "en") for k in range(6)] + [(80, base, None), (81, base, "en")]
    rows += [(100 + k, said(30) + "|" + passage + "|" + said(20), "en") for k in range(5)]
    # ids with several texts: one of them a copy, contaminated, or without letters
    rows += [(3, base, "en"), (5, said(20) + " " + ITEMS[0] + " " + said(9), "en"), (7, "12 34", "en"), (7, said(33), "en")]
    rows += [(9, said(40) + "!" + passage + "!", "en")]
    # rows without an id
    rows += [(None, said(50), "en"), (None, said(60), "en"), (None, ITEMS[0].upper() + " " + said(5), None), (None, "", "en"),
             (None, None, "en"), (None, near(), "en")]
    rows += [(120, "a short item here", "en"), (121, "??", "en"), (122, "x <|endoftext|> y", "en"), (123, "z" * 5000, "en")]
    rows += [(130, "whole copy of a row", "en")] * 3
    out = []
    for k, (name, text, lang) in enumerate(rows):
        mark = 0 if name == 130 else k
        out.append((name, text, lang, "s", len(text or ""), 1000 + mark, f"tie{mark}", mark, f"p{mark}", "sp", mark / 4, mark, f"w{mark}",
                    "row", f"k{mark}", -mark, "g", "b", 5 * mark, "odd"))
    r.shuffle(out)
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    spark.createDataFrame(documents(), SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def order(row):
    return (row[0] is None, row[0] or 0)


def kept_by_language(rows):
    return [x for x in rows if x[1] is not None and any(c.isalpha() for c in x[1])]


def kept_by_likeness(rows):
    rows = sorted(rows, key=order)
    sets, parent = [shingles(x[1]) for x in rows], list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [x for k, x in enumerate(rows) if root(k) == k]


def cut(rows):
    """Rows by id, those without one first; a character goes if all its bytes do."""
    seen, out = set(), []
    for row in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        data = row[1].encode()
        gone, own = bytearray(len(data)), []
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        at, left = 0, []
        for c in row[1]:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                left.append(c)
            at += n
        text = "".join(left)
        if text or not row[1]:
            own = list(row)
            own[1], own[4] = text, len(text)
            out.append(tuple(own))
    return out


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def clean(rows):
    bad = set()
    for item in ITEMS:
        own = words_of(item)
        n = min(10, len(own))
        bad |= {tuple(own[s : s + n]) for s in range(len(own) - n + 1 if n else 0)}
    sizes = {len(w) for w in bad}

    def hit(text):
        words = words_of(text)
        return any(tuple(words[s : s + n]) in bad for n in sizes for s in range(len(words) - n + 1))

    return [x for x in rows if not hit(x[1])]


def bag(df):
    return sorted(map(repr, (tuple(x) for x in df.collect())))


def test_run_against_brute_force(spark, folder):
    rows = documents()
    docs, columns = spark.read.parquet(f"{folder}/documents.parquet"), None
    brute = {"language": kept_by_language, "near_duplicates": kept_by_likeness, "repeated_passages": cut, "benchmark_passages": clean}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == columns and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        path = f"{folder}/after-{name}"
        after.write.parquet(path)
        docs, before = spark.read.parquet(path), rows
        rows = brute[name](rows)
        assert bag(docs) == sorted(map(repr, rows)), name
        assert rows != before
    pieces = corpus_pipeline.run(spark, folder).collect()
    tokenizer, want = Tokenizer.from_file(vocabulary()), collections.Counter()
    for row in rows:
        ids = [*tokenizer.encode(row[1], add_special_tokens=False).ids, 0]
        for s in range(0, len(ids), 1024):
            want[row[0], s, len(ids), tuple(ids[s : s + 1024])] += 1
    import numpy as np

    got, filled = collections.Counter(), collections.defaultdict(list)
    for p in pieces:
        got[p["doc_id"], p["start"], p["doc_tokens"], tuple(np.frombuffer(p["ids"], "<u2").tolist())] += 1
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    assert got == want
    for places in filled.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 1024


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_empty_tables(spark, folder, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, folder).collect() == []


def test_near_duplicates_with_shared_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    docs = spark.createDataFrame([(3, b), (5, a), (5, b), (7, a), (None, c), (None, c), (8, "")], "doc_id long, text string")
    kept = minhash.keep_one(spark, docs, "")
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, [x for x in (
        docs.filter("doc_id = 3").first(), docs.filter("doc_id = 5").filter(docs["text"] == a).first(),
        docs.filter("doc_id is null").first(), docs.filter("doc_id = 8").first())]))
    found = sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"]), r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert found == sorted([("3", 26, "3", True), ("5", 26, "5", True), ("5", 26, "3", False), ("7", 26, "5", False),
                            ("None", 26, "None", True), ("None", 26, "None", False), ("8", 0, "8", True)])


def test_contamination_in_blocks(spark, folder, monkeypatch):
    """Few windows at a time, and a filter that lets everything through, give the same rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id is not null").dropDuplicates(["doc_id"])
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = bag(decontaminate.contamination(docs, benchmark))
    monkeypatch.setattr(decontaminate, "WINDOWS_PER_BLOCK", 1)
    assert bag(decontaminate.contamination(docs, benchmark)) == whole
    import numpy as np

    monkeypatch.setattr(decontaminate, "make_filter", lambda *_: np.full(16, 2**64 - 1, np.uint64))
    assert bag(decontaminate.contamination(docs, benchmark)) == whole
    assert sum("hits=[Row" in repr(x) for x in decontaminate.contamination(docs, benchmark).collect()) == 2


def test_near_matches(spark):
    """Windows found with up to ``slack`` words between their terms."""
    item = "one two three four five six seven eight nine ten"
    texts = [item, "x " + item + " y", "one two three x four five six seven eight nine ten", "one two three x y z four five six seven eight nine ten",
             "one two three four", "one two three four five six x x seven eight nine ten", "nothing of it"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: (len(r["hits"]), r["near"]) for r in decontaminate.contamination(docs, benchmark, slack=2).collect()}
    # terms stand at words 0, 3, 6 and 7 of the window: an exact match, one moved by a word, by three, by two
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 1), 3: (0, 0), 4: (0, 0), 5: (0, 1), 6: (0, 0)}
    exact = {r["doc_id"]: (len(r["hits"]), r["near"]) for r in decontaminate.contamination(docs, benchmark, slack=0).collect()}
    assert exact == {k: (n, 0) for k, (n, _) in got.items()}


def test_special_strings_as_the_library_has_them(spark, tmp_path):
    texts = ["<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>b", "<|endoftext|> <|endoftext|>", "x<|endoftext|>", "<|endoftext|", "é <|endoftext|>\n é"]
    texts += [" ".join([t, "and more words", t]) for t in texts]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(vocabulary())
    want = {k: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["n_tokens"] for r in llm.QUERIES["op5_binary"](spark, str(tmp_path)).collect()} == want
    assert {r["doc_id"]: r["doc_tokens"] for r in llm.QUERIES["op3_packing"](spark, str(tmp_path)).collect()} == want
