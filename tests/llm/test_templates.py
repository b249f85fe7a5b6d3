from vcat.llm import templates

Q = "On Monday Alice bought 12 kg of green apples for 30 dollars and later sold exactly 7 of them to her neighbour Bob while Alice kept the rest"
ITEMS = "item_id long, text string"


def leaks(docs, texts, items=((1, Q),), **kw):
    rows = [(i, t) for i, t in enumerate(texts)]
    out = templates.judge(docs(rows), docs(list(items), ITEMS), **kw).collect()
    return {r.doc_id: r.contaminated for r in out}


def test_copies_and_new_parameters_are_found(docs):
    other = Q.replace("Alice", "Carla").replace("Bob", "Dave").replace("12", "15").replace("30", "44").replace("7 of", "9 of")
    got = leaks(docs, [Q, f"Some words before. {Q} and after", Q.upper(), Q.replace(" ", "\n"), Q.replace(",", "").replace("kg", "lb"), other, f"x {other} y",
                       "Green apples are sold by the neighbour every Monday", None, "", " ".join(Q.split()[:9])])
    assert got == {**dict.fromkeys(range(7), True), **dict.fromkeys(range(7, 11), False)}


def test_slots_have_to_go_one_to_one(docs):
    mixed = Q.replace("Alice bought", "Carla bought").replace("Bob while Alice", "Dave while Erika")  # one name stands for two
    merged = Q.replace("Bob while Alice", "Alice while Alice")  # two stand for one
    table = docs([(0, mixed), (1, merged), (2, Q)])
    rows = {r.doc_id: r for r in templates.find_leaks(table, docs([(1, Q)], ITEMS)).collect()}
    assert not rows[0].slots_agree and not rows[1].slots_agree and rows[2].slots_agree
    assert rows[0].windows < rows[2].windows == rows[2].item_windows


def test_short_items_are_whole_texts(docs):
    items = [(1, "What is 3 plus 4"), (2, None), (3, "")]
    assert leaks(docs, ["What is 5 plus 9", "Well, what is 5 plus 9 then", "what is 5 minus 9"], items) == {0: True, 1: False, 2: False}


def test_removal_keeps_columns_repeats_and_null_ids(docs):
    rows = [(None, Q, 1, "a"), (None, "clean", 2, "b"), (3, Q, 3, "c"), (3, "other text", 4, "d"), (5, "same", 5, "e"), (5, "same", 6, "f")]
    d = docs(rows, "doc_id long, text string, text_hash long, _text_hash string")
    out = templates.remove_leaks(d, docs([(1, Q)], ITEMS))
    assert out.columns == d.columns
    assert sorted(r.text_hash for r in out.collect()) == [2, 4, 5, 6]
    assert templates.remove_leaks(d.limit(0), docs([(1, Q)], ITEMS)).count() == 0
    assert templates.remove_leaks(d, docs([], ITEMS)).count() == 6


def test_against_plain_windows(docs):
    import random

    rng = random.Random(6)
    pool = [f"w{chr(97 + i)}" for i in range(9)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(8, 14)))) for i in range(6)]
    texts = [" ".join(rng.choice(pool) for _ in range(20)) for _ in range(30)]
    texts += [" ".join(rng.choice(pool) for _ in range(5)) + " " + items[i % 6][1][:rng.randint(10, 60)] for i in range(30)]
    width, least = 4, 2
    got = leaks(docs, texts, items, width=width, least=least)
    for i, t in enumerate(texts):
        w, hit = t.split(), False
        for _, x in items:
            v = x.split()
            by = {}
            for p in range(len(w) - width + 1):
                for q in range(len(v) - width + 1):
                    if w[p:p + width] == v[q:q + width]:
                        by.setdefault(p - q, set()).add(q)
            hit |= any(len(s) >= least for s in by.values())
        assert got[i] == hit


def test_short_items_are_found_inside_texts(docs):
    items = [(1, "What is 3 plus 4"), (2, "Name it"), (3, "alone")]
    got = leaks(docs, ["Well, they asked: what is 3 plus 4? Nobody in the room could say it at once", "Nobody could name it in time", "what is 3 plus", "They left him ALONE!", "it name"], items)
    assert got == {0: True, 1: True, 2: False, 3: True, 4: False}


def test_items_of_placeholders_are_found_as_copies(docs):
    series, people, pair = "2 3 5 7 11 13 17 19 23 29", "Then Ada Grace Alan Kurt Emmy Paul John Edsger Donald met", "12 34"
    items = [(1, series), (2, people), (3, pair)]
    got = leaks(docs, [f"The primes are {series} and so on", f"We read that {people.lower()} there", "56 78", "see 12 34 here", "1 4 6 8 10 12 14 16 18 20",
                       "Then Ida Green Adam Karl Anna Pete Jack Erwin David met"], items)
    assert got == {0: True, 1: True, 2: False, 3: True, 4: False, 5: False}


def test_copies_behind_anything_and_in_any_case(docs):
    item = "Trains leave the station every 20 minutes until late evening"
    named = "yesterday Maria drove along a road beside Straßburg before noon and met Otto by chance"
    got = leaks(docs, [f"A heading\n{item}", f"first, {item}", f"(see {item})", f"\"quoted\" {item}", f"A heading\n{item.replace('20', '35')}", f"Before. {item.replace('20', '35')}",
                       named.upper(), named.lower(), f"Some say {named.title()}"], [(1, item), (2, named), (3, "- " + item)])
    assert got == dict.fromkeys(range(9), True)


def test_tokens_do_not_depend_on_other_text(docs):
    for k, name in enumerate(["(Maria)", "\"Anna", "O'Brien", "iPhone", "ǅemal", "x-Ray"]):
        words = f"somebody gave {name} a basket of very fresh pears"
        other = words.replace(name, {"(Maria)": "(Clara)", "\"Anna": "\"Lena", "O'Brien": "O'Neill", "iPhone": "iPad", "ǅemal": "ǅon", "x-Ray": "y-Ray"}[name])
        got = leaks(docs, [f"In 1999 {words}", words, f"in 1999 {other}", other, "all said " + words.replace("very", "nine")], [(1, words)])
        assert got == {0: True, 1: True, 2: True, 3: True, 4: False}, name
