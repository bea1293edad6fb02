import hashlib
import random
import re

import pytest

from grainline.llm import sanitise as S


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(["a", "B.", "@", "@x.co", ".", "-", " ", "+1 (", "555", "4111 1111 1111 1111", "1.2.3.4", "256", "0", "é", "\n", "+", "%"], k=12))
        assert S.base_spans(text) == brute(text), text


def test_given_documents(spark, sf_small):
    from grainline.llm import queries
    got = {r.doc_id: r for r in queries.op4_personal_data(spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        want = S.render(brute(r.text))
        assert got[r.doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert got[r.doc_id].spans.startswith(want)
        assert got[r.doc_id].n_email == want.count("email:")


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    word = lambda: "w" + "".join(rng.choices("abcdefghij", k=4))
    line = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{line(5)} Zephyrine {line(3)} zed@clinic.example {line(5)} the rest") for i in range(8)]      # a telling name
    rows += [(100 + i, f"{line(6)} the common word {line(5)}") for i in range(50)]
    rows += [(200 + i, "Solo passage about Quixana here q@x.example as it was copied") for i in range(9)]       # one copied context
    base = [word() for _ in range(30)]
    for i in range(40):                                                                                         # near copies of one passage
        copy = [w if rng.random() > 0.12 else word() for w in base]
        rows.append((400 + i, " ".join([*copy[:15], "near@copy.example", *copy[15:]])))
    rows += [(300, None), (301, ""), (302, rows[0][1]), (302, rows[0][1]), (None, "x 1.2.3.4 y")]
    return rows, spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, spans string")


def test_terms_that_reveal_an_entity(corpus):
    rows, df = corpus
    got = S.find(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in range(8):
        text = rows[i][1]
        at = text.index("Zephyrine")
        assert f"term:{at}:{at + 9}" in by_id[i].spans.split(",")
        assert f":{text.index('the rest')}:" not in by_id[i].spans       # 'the' occurs elsewhere too
    assert all("term" not in by_id[200 + i].spans and by_id[200 + i].n_email == 1 for i in range(9))
    assert all(by_id[400 + i].n_terms == 0 and by_id[400 + i].n_email == 1 for i in range(40))
    assert by_id[300].spans == by_id[301].spans == "" and by_id[None].n_ip == 1
    assert [r.n_terms for r in got if r.doc_id == 302] == [by_id[0].n_terms] * 2


def plain_disclosure(texts):
    """term -> largest disclosure for any entity that may give an estimate, by plain counting."""
    from collections import Counter, defaultdict
    from math import log2
    term = re.compile(r"[^\W\d_]{3,}")
    n_term, total, near, contexts = Counter(), 0, defaultdict(Counter), defaultdict(list)
    for text in texts:
        text = text or ""
        spans = sorted(S.base_spans(text), key=lambda x: x[1:])
        total += text.count(" ") + text.count("\n") + 1 if text else 0
        blank = list(text)
        for _, s, e in spans:
            blank[s:e] = " " * (e - s)
        at = [(m.start(), m.group().lower()) for m in term.finditer("".join(blank))]
        n_term.update(t for _, t in at)
        seen = set()
        for k, s, e in spans:
            value = f"{k}:{text[s:e].lower()}"
            around = [x for x in at if x[0] < s][-12:] + [x for x in at if x[0] >= e][:12]
            contexts[value].append(tuple(t for _, t in around))
            for x in around:
                if (value, x) not in seen:
                    seen.add((value, x))
                    near[value][x[1]] += 1
    out = {}
    for value, counts in near.items():
        different = set(contexts[value])
        holds = Counter(t for c in different for t in set(c))
        constant = [n for n in holds.values() if 2 * n > len(different)]
        if len(different) < 3 or len(constant) >= 8 or constant and sum(constant) >= 0.8 * sum(holds.values()):
            continue
        n_value = sum(counts.values())
        for t, n in counts.items():
            if holds[t] >= 3:
                d = log2(total * n / (n_term[t] * n_value)) / max(log2(total / n_value), 1e-9)
                out[t] = max(out.get(t, d), d)
    return out


@pytest.mark.parametrize("few", [S.FEW_TERMS, 2])
def test_disclosure_equals_plain_counting(spark, monkeypatch, few):
    monkeypatch.setattr(S, "FEW_TERMS", few)                            # as an automaton, and as a filter
    rng = random.Random(9)
    names, words = ["Quixana", "Doe", "Zed"], ["wrote", "and", "then", "the", "wé", "report", "of", "sales", "to", "Lima", "über", "sent"]
    words += [f"{a}{b}" for a in ("mar", "tol", "wé", "sun") for b in ("bel", "DOR", "fin", "ga", "x-y", "7th", "ner")]
    texts = []
    for i in range(150):
        words_here = rng.choices(words, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            who = rng.randrange(3)
            words_here.insert(rng.randint(0, len(words_here)), rng.choice([f"{names[who]} <u{who}@x.com>", f"u{who}@x.com", "10.0.0.7", f"{names[who]}\nu{who}@x.com"]))
        texts.append(rng.choice([" ", "\n", "  "]).join(words_here))
    texts += [None, "", *texts[:5]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    _, told = S._findings(df)
    want = {t: d for t, d in plain_disclosure(texts).items() if d >= S.DISCLOSURE}
    got = {r.term: r.disclosure for r in told.collect()}
    assert want and got.keys() == want.keys()
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)
    # every occurrence is marked, wherever it stands
    for r in S.find(df).collect():
        text = texts[r.doc_id] or ""
        marks = sorted((m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", S.bare(text)) if m.group().lower() in want)
        assert [x for x in r.spans.split(",") if x.startswith("term")] == [f"term:{a}:{b}" for a, b in marks] and r.n_terms == len(marks)


def filler(rng, n):
    return " ".join("v" + "".join(rng.choices("bcdfghklm", k=5)) for _ in range(n))


def masked(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in S.sanitise(df).orderBy("doc_id").collect()]


def test_finder_equals_the_plain_pattern():
    rng = random.Random(11)
    terms = ["abc", "abcd", "ünt", "οδος", "i̇st", "xyz", "²³¹"]
    finder = S.Finder(terms)
    for _ in range(4000):
        text = "".join(rng.choices(["abc", "ABCD", "Ünt", "ΟΔΟΣ", "İst", "xyz", "²³¹", "_", "1", " ", "'", "q", "-", "abc@x.co", "\n"], k=9))
        want = [(m.group().lower(), *m.span()) for m in re.finditer(r"[^\W\d_]{3,}", S.bare(text)) if m.group().lower() in terms]
        assert list(finder.spans(text)) == want, text


def test_a_name_beside_an_address_in_few_words(spark):
    rng = random.Random(2)
    texts = [f"Jane Doe <j@x.com> {rng.choice(['wrote', 'replied'])} {filler(rng, 2)}" for _ in range(12)]
    texts += [f"{filler(rng, 30)} wrote and replied {filler(rng, 30)}" for _ in range(60)]
    out = masked(spark, texts)
    assert all("Jane" not in t and "Doe" not in t and "@" not in t for t in out)
    assert out[12:] == texts[12:]


def test_a_name_on_another_line_and_in_headers(spark):
    rng = random.Random(3)
    texts = [f"{filler(rng, 8)}\nQuixana\nq@x.com\n{filler(rng, 8)}" for _ in range(12)]
    texts += [f"Zephyr Vole, z@y.org\n{filler(rng, 20)}" for _ in range(40)]           # one header line, word for word
    texts += [filler(rng, 40) for _ in range(60)]
    out = masked(spark, texts)
    assert all("Quixana" not in t and "Zephyr" not in t and "Vole" not in t for t in out)
    assert out[52:] == texts[52:]


def test_copies_of_a_short_document_tell_nothing(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(20):
        words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
        words[rng.randrange(6)] += "".join(rng.choices("xyz", k=2))
        texts.append(" ".join([*words[:3], "n@copy.org", *words[3:]]))
    texts += [filler(rng, 40) for _ in range(60)]
    out = masked(spark, texts)
    assert out == [t.replace("n@copy.org", "[email]") for t in texts]


def test_every_occurrence_of_a_telling_term(spark):
    rng = random.Random(4)
    texts = [f"{filler(rng, 9)} Quixana {filler(rng, 2)} q@x.com {filler(rng, 9)}" for _ in range(12)]
    texts += [f"{filler(rng, 50)} Quixana {filler(rng, 50)}" for _ in range(2)]          # nowhere near an address
    texts += [filler(rng, 60) for _ in range(300)]
    out = masked(spark, texts)
    assert all("Quixana" not in t for t in out) and out[14:] == texts[14:]


def test_long_lines_take_linear_time():
    import time
    for text in ("a@b.co " * 20_000, "Name a@b.co, " * 20_000, "1.2.3.4" + "x" * 2_000_000 + " 1.2.3.4", "w " * 500_000 + "a@b.co"):
        begin = time.monotonic()
        spans = S.base_spans(text)
        found, _ = S.contexts(text, spans)
        assert len(found) == len(spans) and time.monotonic() - begin < 5


def test_sanitised_texts(corpus):
    rows, df = corpus
    out = S.sanitise(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert not brute(r.text) and "Zephyrine" not in (r.text or "")
    clean = {i: t for i, t in rows if i is not None and 100 <= i < 200}
    assert {r.doc_id: r.text for r in got if r.doc_id in clean} == clean
    assert [r.text for r in got if r.doc_id == 300] == [None]
    assert S.find(df.limit(0)).count() == 0 and S.sanitise(df.limit(0)).count() == 0
