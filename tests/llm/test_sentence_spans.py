import re

import pandas as pd

from fennec.llm.queries import QUERIES
from fennec.llm.sentence_spans import CLAUSE_MARKS, MARKS, MIN_WORDS, REACH, cut, dedup_spans, spans, word_code


def mixed(a, b):
    """The key of a place between two words, clause marks first."""
    m = (1 << 64) - 1
    x = (word_code(a) * 0x9E3779B97F4A7C15 & m) ^ (word_code(b) * 0xC2B2AE3D27D4EB4F & m)
    return a[-1] not in CLAUSE_MARKS, ((x ^ x >> 29) * 0xBF58476D1CE4E5B9 & m) >> 1


def sentences(text):
    """(start, end) of the parts of a text, word by word."""
    found = list(re.finditer(r"\S+", text))
    runs = []
    for i, m in enumerate(found):
        if i == 0 or found[i - 1].group()[-1] in MARKS or "\n" in text[found[i - 1].end():m.start()]:
            runs.append([])
        runs[-1].append(m)
    starts = []
    for run in runs:
        starts.append(run[0].start())
        keys = [mixed(a.group(), b.group()) for a, b in zip(run, run[1:])]
        for i in range(REACH, len(keys) - REACH):
            if all(keys[i] < keys[j] for j in range(i - REACH, i + REACH + 1) if j != i):
                starts.append(run[i + 1].start())
    ends = [0, *starts[1:], len(text)]
    return list(zip(ends, ends[1:])) if starts else []


def brute(rows, least=MIN_WORDS):
    """(id, text) rows, ids unique: id -> (text, sentences, removed)."""
    rows = sorted(rows)
    first, seen = {}, []
    for ident, text in rows:
        words = [text[a:b].split() for a, b in sentences(text)]
        found, ends = set(), set()
        for s in range(len(words)):
            for e in range(s, len(words)):
                if sum(map(len, words[s:e + 1])) >= least:
                    found.add((s, e))
                    ends.add(e)
                    break
        for e in set(range(len(words))) - ends:
            for s in range(e, -1, -1):
                if sum(map(len, words[s:e + 1])) >= least:
                    found.add((s, e))
                    break
        for s, e in found:
            key = tuple(" ".join(w) for w in words[s:e + 1] if w)
            seen.append((key, ident, s, e))
            first[key] = min(first.get(key, (ident, s, e)), (ident, s, e))
    gone = {}
    for key, ident, s, e in seen:
        if first[key] != (ident, s, e):
            gone.setdefault(ident, set()).update(range(s, e + 1))
    out = {}
    for ident, text in rows:
        lost = gone.get(ident, ())
        parts = sentences(text)
        kept = "".join(text[a:b] for i, (a, b) in enumerate(parts) if i not in lost)
        out[ident] = (kept.rstrip() if len(parts) - 1 in lost else kept, len(parts), len(lost))
    return out


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    want = brute([(i, t) for i, t in zip(docs.doc_id, docs.text)])
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in QUERIES["op6_sentence_spans"](spark, sf).collect()}
    assert got == want and sum(x[2] for x in want.values()) > 0


def test_passages_are_removed_and_clean_texts_stay(spark):
    passage = " ".join(f"Word{i} goes here with the number {i}." for i in range(9))  # 63 words
    own = [f"This is text {i} that nobody else has. " * 1 + " ".join(f"w{i}x{j}" for j in range(40)) + "." for i in range(6)]
    texts = [f"{o} {passage} End of {i}." if i < 4 else o for i, o in enumerate(own)]
    texts.append("Before it broke off " + passage + " and then it went on.")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.text for r in dedup_spans(df).collect()}
    assert got[0] == texts[0]
    for i in (1, 2, 3):
        assert "Word4" not in got[i] and own[i] in got[i] and f"End of {i}." in got[i]
    assert got[4] == texts[4] and got[5] == texts[5]
    assert "Word4" not in got[6] and got[6].startswith("Before it broke off Word0")


def test_spans_cover_the_end_of_a_passage():
    _, s, e, _ = spans(cut(["One two three four. " * 3 + "Five six."]), 6)
    assert (0, 1) in set(zip(s, e)) and 3 in e and len(set(zip(s, e))) == len(s)


def test_texts_cut_together_are_cut_as_alone():
    texts = ["", "one", " lead\n\nand tail \n", " ".join(f"w{i % 40}" for i in range(300)), "A b. " * 30, "\n"]
    whole = cut(texts)
    for i, t in enumerate(texts):
        alone = cut([t])
        assert (whole.start[whole.first_part[i]:whole.first_part[i + 1]] - whole.first_word[i]).tolist() == alone.start.tolist()
        assert len(alone.start) == len(sentences(t))


def test_repeats_inside_one_text_go(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    stops = " ".join(f"Word{i} goes here with the number {i}." for i in range(10))
    df = spark.createDataFrame([(1, " ".join([passage] * 5)), (2, " ".join([stops] * 5))], "doc_id int, text string")
    got = {r.doc_id: r.text.split() for r in dedup_spans(df).collect()}
    # up to a part stays at each edge of what repeats
    assert 60 <= len(got[1]) < 100 and got[1][:60] == passage.split()
    assert got[2] == stops.split()


def test_odd_rows(spark, odd_docs, no_docs):
    got = dedup_spans(odd_docs, min_words=10).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == odd_docs.count()
    assert by[1][0].text is None and by[2][0].text == "" and by[6][0].n_removed > 0
    assert len({r.text for r in by[4]}) == 1 and by[4][0].text and by[5][0].text == ""
    # 977 words over and over: about one round of them stays
    assert by[6][0].text.startswith("word0 word1 ") and 977 <= len(by[6][0].text.split()) < 1100
    assert dedup_spans(no_docs).count() == 0


def test_passages_that_start_and_end_amid_long_sentences(spark):
    lost = []
    rows = []
    for case in range(30):
        passage = " ".join(f"p{case}w{j}" for j in range(60))
        for k in range(2):
            before, after = (" ".join(f"{x}{case}k{k}n{j}" for j in range(40)) for x in "ab")
            rows.append((2 * case + k, f"{before} {passage} {after}."))
    got = {r.doc_id: r for r in dedup_spans(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, text in rows:
        if i % 2 == 0:
            assert got[i].text == text
        else:
            lost.append(len(text.split()) - len(got[i].text.split()))
    assert all(x <= 60 for x in lost) and sum(x >= 25 for x in lost) >= 29
