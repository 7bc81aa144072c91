from collections import defaultdict

from rankweave.llm import decontaminate as d

ITEM = "A train with Alice and Bob leaves the old station at 9 and runs 120 km in two hours, so how fast did Alice travel on that train?"


def rows(spark, texts, items):
    docs = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, h string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in d.contaminated(docs, bench).collect()}


def test_reparameterised_questions_need_consistent_slots(spark):
    changed = ITEM.replace("Alice", "Maria").replace("Bob", "John").replace("120", "300").replace("two", "five").replace(" 9 ", " 7 ")
    broken = ITEM.replace("did Alice", "did Bob")
    clean = "A train is a fine thing and the station is old, but nobody here asks how fast anyone did travel on it today at all."
    texts = [(1, "Some words. " + ITEM), (2, "Some words. " + changed + " The end."), (3, broken), (4, clean), (5, None), (6, ""), (7, ITEM.upper()), (8, ITEM + " " + changed), (1, "twice")]
    got = rows(spark, texts, [(10, ITEM), (11, "too short"), (12, None)])
    assert sorted(got) == [(1, 10), (2, 10), (8, 10)]  # upper-case words are no names, so that 7 has other templates
    assert got[1, 10].exact and not got[2, 10].exact
    assert rows(spark, [], [(10, ITEM)]) == {} == rows(spark, texts, [])


def test_windows_equal_word_by_word_templates():
    text = "He paid 5 dollars. Then Anna (from Rome) took 12kg of rice, 3.5% more than he did in 1999!"
    one, two = d.Templates(), d.Templates()
    h, at, slots = one.windows(one.template(text))
    h2, _, _ = two.windows(two.template(text.replace("Anna", "Eva").replace("1999", "2001").replace("12kg", "7kg")))
    assert h.tolist() == h2.tolist()
    words = text.split()
    assert len(words) - d.WINDOW + 1 >= len(h) > 0
    assert any(s and "anna" in s for s in slots)


def plain_template(text):
    """(token, value of a slot or None) of each word, one word after the other."""
    out, ended = [], True
    for word in (text or "").split():
        core = word.strip(d._MARKS)
        core = core if core.isalpha() else d._BARE.sub("", word)
        if not core:
            continue
        low = core.lower()
        if low in d.NUMBER_WORDS or (not core.isalpha() and d._NUMERIC.fullmatch(core)):
            out.append((d.NUMBER, low))
        elif low in d.UNIT_WORDS:
            out.append((d.UNIT, low))
        elif not ended and len(core) > 1 and core[0] != low[0] and core[1:] == low[1:]:
            out.append((d.NAME, low))
        else:
            out.append((low, None))
        ended = word[-1] in ".!?:" or word[-2:-1] in (".", "!", "?")
    return out


def plain_windows(words, size, whole):
    """(place, template, slots) of the windows that count."""
    out = []
    for i in range(len(words) - size + 1):
        part = words[i : i + size]
        slots = tuple(v for _, v in part if v is not None)
        if 2 * len(slots) <= size:
            out.append((i, (size, tuple(t for t, _ in part)), slots))
        elif whole and len(slots) < size:
            out.append((i, (-size, tuple(t if v is None else v for t, v in part)), slots))
    return out


def plain_contaminated(docs, items):
    usual = {i: plain_windows(plain_template(t), d.WINDOW, False) for i, t in items.items()}
    whole = {i: plain_windows(w, len(w), True) for i, t in items.items() if not usual[i] and len(w := plain_template(t)) >= d.SHORTEST}
    found = {}
    for k, text in docs.items():
        words = plain_template(text)
        own = plain_windows(words, d.WINDOW, False)
        for i in items:
            mine = usual[i] or whole.get(i, [])
            theirs = own if usual[i] else plain_windows(words, len(plain_template(items[i])), True)
            places = defaultdict(lambda: (set(), set()))
            for pos, template, slots in theirs:
                for ipos, itemplate, islots in mine:
                    if template == itemplate:
                        at, pairs = places[pos - ipos]
                        at.add(ipos)
                        pairs |= set(zip(islots, slots, strict=True))
            good = [(at, pairs) for at, pairs in places.values() if len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})]
            held = set().union(*(at for at, _ in good))
            if held and (len(held) >= d.SHARE * len({p for p, _, _ in mine}) or max(len(at) for at, _ in good) >= d.PASSAGE):
                found[k, i] = (len(held), all(a == b for _, pairs in good for a, b in pairs))
    return found


def test_equals_a_plain_matcher(spark):
    import random

    rng = random.Random(2)
    vocabulary = ["the", "a", "runs", "Anna", "Ben", "Carl", "in", "7", "12", "five", "km", "hours", "old", "train", "so.", "how?", "sum"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = {i: make(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 14, 40, 90])) for i in range(40)} | {90: "3 + 4 is 7", 91: "5 6 7 8 9 10 11 12 km 3", 92: None, 93: "the capital of France is Paris now"}
    docs = {}
    for k in range(120):
        base = (items[rng.choice(list(items))] or "").split()
        for _ in range(rng.randint(0, 2)):
            if base:
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
        docs[k] = " ".join([make(rng.randint(0, 6)), *base[rng.randint(0, 3) :], make(rng.randint(0, 6))])
    docs |= {200: "So 3 + 4 is 7 , as is known", 201: "So 3 + 5 is 8 , as is known", 202: "I know the capital of France is Paris now", 203: "I know the capital of Spain is Madrid now", 204: None}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id): (r.matched, r.exact) for r in d.contaminated(frame, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    want = plain_contaminated(docs, items)
    assert got == want
    assert (200, 90) in got and (201, 90) not in got and {(202, 93), (203, 93)} <= got.keys()


def test_a_passage_of_a_long_item_counts(spark):
    item = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    part, less = " ".join(item.split()[50:90]), " ".join(item.split()[50:75])
    assert sorted(rows(spark, [(1, part), (2, less)], [(1, item)])) == [(1, 1)]


def test_whole_table_holds_the_plain_leaks(spark):
    folder = "/root/testdata/sf0.01"
    items = {r.item_id: r.text.split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    at, need = defaultdict(set), {}
    for i, w in items.items():
        need[i] = len({tuple(w[k : k + 8]) for k in range(len(w) - 7)})
        for k in range(len(w) - 7):
            at[tuple(w[k : k + 8])].add(i)
    plain = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        w, hit = r.text.split(), defaultdict(set)
        for k in range(len(w) - 7):
            for i in at.get(tuple(w[k : k + 8]), ()):
                hit[i].add(tuple(w[k : k + 8]))
        plain |= {(r.doc_id, i) for i, x in hit.items() if len(x) >= 0.5 * need[i]}
    got = {(r.doc_id, r.item_id): r.share for r in d.op2_decontaminate(spark, folder).collect()}
    assert plain and plain <= got.keys()
    assert len(got) <= len(plain) + 5
