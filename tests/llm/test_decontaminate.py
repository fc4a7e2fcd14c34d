import random
import re

from peerwatch.llm.decontaminate import (
    LITERALS,
    NAME,
    NUMBER,
    QUOTED,
    SHARE,
    UNIT,
    UNITS,
    WINDOW,
    _hash,
    _Kinds,
    _Numbers,
    contaminated,
    name_template,
    op7_decontaminate,
    template,
    template_codes,
    window_hashes,
    without_contaminated,
)

ITEMS = [
    (1, "Say Tom has 12 apples and gives 5 apples to Anna before walking 3 km home with Tom again"),
    (2, "the quick brown fox jumps over the lazy dog near the quiet river bank today"),
    (3, "only four plain words"),
    (4, "1 2 3 4 5 6 7 8 9 10"),
    (5, None),
]
DOCS = [
    (1, "Some text. Yesterday Tom has 12 apples and gives 5 apples to Anna before walking 3 km home with Tom again"),
    (2, "Well, Mary has 40 apples and gives 7 apples to Peter before walking 9 miles home with Mary again, they say"),
    (3, "Well, Mary has 40 apples and gives 7 apples to Peter before walking 9 miles home with Susan again, they say"),
    (4, "THE QUICK brown fox, jumps over the lazy dog near the quiet river bank!"),
    (5, "the quick brown fox sat down and the lazy dog went to another river far away"),
    (6, "only four plain words"), (7, "1 2 3 4 5 6 7 8 9 10"), (8, None), (9, ""), (None, "x the quick brown fox jumps over the lazy dog near the quiet river bank"),
    (4, "clean text with the id of another row in it and nothing else"),
]


def brute(docs, items):
    kinds, out = _Kinds(), set()
    made = {}
    for item, text in items:
        words, values = template(text or "", kinds)
        size = min(WINDOW, max(1, len(words)))
        made[item] = [(i, words[i : i + size], values[i : i + size]) for i in range(len(words) - size + 1) if sum(w not in (NAME, NUMBER, UNIT) for w in words[i : i + size]) >= LITERALS]
    for doc, text in docs:
        words, values = template(text or "", kinds)
        for item, windows in made.items():
            shifts = {}
            for i, w, v in windows:
                for p in range(len(words) - len(w) + 1):
                    if words[p : p + len(w)] == w:
                        shifts.setdefault(p - i, []).append((i, v, values[p : p + len(w)]))
            found, quoted = set(), 0
            for met in shifts.values():
                slots = {}
                for _, mine, theirs in met:
                    for a, b in zip(mine, theirs):
                        if a is not None:
                            slots.setdefault(a, set()).add(b)
                if all(len(s) == 1 for s in slots.values()):
                    found |= {i for i, _, _ in met}
                    own = {i for i, v, w in met if v == w}
                    quoted = max([quoted, *(next(n for n in range(len(words) + 2) if i + n not in own) for i in own)])
            if windows and (len(found) >= SHARE * len(windows) or quoted >= QUOTED - WINDOW + 1):
                out.add((doc, item, len(windows), len(found)))
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, hash int"), spark.createDataFrame(
        [(*i, "x") for i in items], "item_id long, text string, doc_id string"
    )


def test_exact_and_with_other_parameters(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    got = contaminated(spark, docs, items).collect()
    assert {(r.doc_id, r.item_id, r.windows, r.found) for r in got} == brute(DOCS, ITEMS)
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (4, 2), (6, 3), (None, 2)}
    assert {r.doc_id: r.exact for r in got if r.item_id == 1} == {1: True, 2: False}
    kept = without_contaminated(spark, docs, items)
    assert kept.columns == docs.columns
    assert sorted(re.sub(r"\W+", " ", r.text or "")[:9] for r in kept.where("doc_id = 4").collect()) == ["clean tex"]
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5, 7, 8, 9}


def test_random_texts(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["Tom", "Ann", "7", "12", "km", "5kg", "End."]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 30)))) for i in range(12)]
    docs = []
    for d in range(40):
        words = [rng.choice(vocabulary) for _ in range(40)]
        part = items[rng.randrange(12)][1].split()
        part = [{"Tom": "Bob", "7": "99"}.get(w, w) for w in part] if rng.random() < 0.4 else part
        words[10:10] = part[rng.randrange(1 + len(part) // 2) :]
        docs.append((d, " ".join(words)))
    a, b = frames(spark, docs, items)
    assert {(r.doc_id, r.item_id, r.windows, r.found) for r in contaminated(spark, a, b).collect()} == brute(docs, items)


def test_empty_tables(spark, folder):
    docs, items = frames(spark, DOCS, ITEMS)
    assert contaminated(spark, docs, items.limit(0)).count() == 0
    assert without_contaminated(spark, docs, items.limit(0)).count() == len(DOCS)
    docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    assert op7_decontaminate(spark, folder).count() == 0


def test_codes_are_those_of_the_template():
    rng = random.Random(9)
    numbers = _Numbers(_Kinds())
    parts = ["Tom", "tom.", "5kg", "...", "12", "km", "\n", "\n\n", "End!", "É", "a", "—", '"Quote."', " ", " ", "USA", "“", "7ml."]
    for _ in range(300):
        texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(20))) for _ in range(rng.randrange(1, 6))]
        for (codes, text), made in zip(template_codes(texts, numbers), (template, name_template), strict=True):
            for i, own in enumerate(texts):
                assert codes[text == i].tolist() == [_hash(w) for w in made(own, numbers.kinds)[0]]


def test_windows_of_many_texts():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "b", "Tom", "7", "c."]) for _ in range(rng.randrange(14))) for _ in range(30)]
    numbers = _Numbers(_Kinds())
    apart = {}
    for i, own in enumerate(texts):
        codes, text = template_codes([own], numbers)[0]
        for size, hashed in window_hashes(codes, text, [5, 8]):
            apart[i, size] = hashed.tolist()
            assert len(hashed) == len(codes)
    codes, text = template_codes(texts, numbers)[0]
    for size, hashed in window_hashes(codes, text, [5, 8]):
        assert all(hashed[text == i].tolist() == apart[i, size] for i in range(30))


def plain_forms(text):
    """Both templates, written out apart from the operator: (word, value) pairs."""
    forms, units = ([], []), set(UNITS)
    for line in re.split("[\n\r]", text):
        begin = True
        for word in line.split():
            core = word.strip(".,;:!?()[]{}\"'“”‘’«»…")
            if not core:
                begin = begin or word[-1] in ".!?:"
                continue
            number, measure = re.fullmatch(r"[+-]?[$€£]?\d[\d.,:/]*%?", core), re.fullmatch(r"([+-]?\d[\d.,]*)([A-Za-z]+)", core)
            if number:
                parts = [("<number>", core)]
            elif measure and measure[2].lower() in units:
                parts = [("<number>", measure[1]), ("<unit>", measure[2].lower())]
            elif core.lower() in units:
                parts = [("<unit>", core.lower())]
            else:
                parts = [(core.lower(), None)]
            word_name = parts[0][1] is None
            first = [("<name>", core.lower())] if word_name and not begin and core[0].isupper() and core[1:].islower() else parts
            forms[0].extend(first)
            if word_name and core[0].isupper():
                if forms[1] and forms[1][-1][0] == "<name>":
                    forms[1][-1] = ("<name>", core.lower())
                else:
                    forms[1].append(("<name>", core.lower()))
            else:
                forms[1].extend(parts)
            begin = word.rstrip("\"')]”’»")[-1:] in (".", "!", "?", ":")
    return forms


def brute_forms(docs, items):
    """(doc, item) pairs by both forms, the share, and the quotations."""
    made = {k: plain_forms(t or "") for k, t in {**{("i", i): t for i, t in items}, **{("d", d): t for d, t in docs}}.items()}
    out = set()
    for item, _ in items:
        for doc, _ in docs:
            for mine, theirs in zip(made["i", item], made["d", doc], strict=True):
                size = min(WINDOW, max(1, len(mine)))
                windows = [i for i in range(len(mine) - size + 1) if sum(v is None for _, v in mine[i : i + size]) >= LITERALS]
                found, quoted = set(), 0
                for shift in range(-len(mine), len(theirs)):
                    met = [i for i in windows if 0 <= i + shift and [w for w, _ in mine[i : i + size]] == [w for w, _ in theirs[i + shift : i + shift + size]]]
                    values = {}
                    for i in met:
                        for (_, a), (_, b) in zip(mine[i : i + size], theirs[i + shift : i + shift + size], strict=True):
                            if a is not None:
                                values.setdefault(a, set()).add(b)
                    if all(len(v) == 1 for v in values.values()):
                        found.update(met)
                        run = 0
                        for i in range(len(mine)):
                            run = run + 1 if i in met and mine[i : i + size] == theirs[i + shift : i + shift + size] else 0
                            quoted = max(quoted, run)
                if windows and (len(found) >= SHARE * len(windows) or quoted >= QUOTED - WINDOW + 1):
                    out.add((doc, item))
    return out


def test_both_forms_against_brute_force(spark):
    rng = random.Random(21)
    vocabulary = ["the", "boat", "is", "red", "and", "was", "seen", "by", "many", "people", "there", "Tom", "Ann", "USA", "7", "12", "km", "5kg", "day.", "so:", "..."]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(4, 70)))) for i in range(14)]
    docs = []
    for d in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        part = items[rng.randrange(14)][1].split()
        if rng.random() < 0.6:
            part = [{"Tom": "Bob", "Ann": "McDonald", "7": "99", "12": "8"}.get(w, w) for w in part]
        at = rng.randrange(1 + len(part))
        words[5:5] = part[at : at + rng.choice((9, 13, 20, 80))]
        docs.append((d, "".join(w + rng.choice("   \n") for w in words)))
    got = {(r.doc_id, r.item_id) for r in contaminated(spark, *frames(spark, docs, items)).collect()}
    assert got == brute_forms(docs, items) and len(got) > 20


def test_a_long_quotation_of_a_longer_item(spark):
    item = " ".join(f"word{i}" for i in range(60))
    docs = [(1, "so " + " ".join(f"word{i}" for i in range(20, 33)) + " it says"), (2, "so " + " ".join(f"word{i}" for i in range(20, 32)) + " it says"), (3, "x " * 30_000 + item)]
    got = contaminated(spark, *frames(spark, docs, [(1, item)])).collect()
    assert {(r.doc_id, r.found, r.exact) for r in got} == {(1, 6, True), (3, 53, True)}


def test_names_where_sentences_and_lines_begin(spark):
    items = [(1, "Tom has 12 apples. Anna gives Tom 5 more. How many apples does Tom have now?"), (2, "then we ask McDonald to bring the red boat over to NASA before night falls")]
    docs = [
        (1, "Bill has 30 apples. Mary gives Bill 7 more. How many apples does Bill have now?"),
        (2, "Bill has 30 apples. Mary gives Bill 7 more.\nHow many apples does Tom have now?"),
        (3, "well then we ask\nO'Neil to bring the red boat over to\nESA before night falls"),
        (4, "Some other text. With names of Tom and Anna who have no more apples now"),
    ]
    got = contaminated(spark, *frames(spark, docs, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (3, 2)}
