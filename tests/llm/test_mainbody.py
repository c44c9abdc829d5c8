import itertools
import json
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import boosting, mainbody
from sluice.llm.pageviews import Page, learn_labels, learn_views, seed_labels

SENTENCES = ["The board of {x} closed its theatre after a long review.", "Few people in {x} had expected the news.", "Investors led by {x} put 3 million into the old mill.", "Neither {x} nor the mayor would comment on the plan."]
TABLES = os.environ.get("SLUICE_TEST_TABLES", "/root/testdata/sf0.001")


def make(n):
    """A page and the numbers of its body lines."""
    rng = random.Random(n)
    name = lambda: rng.choice(["Oxford", "Dunmere", "Kirnhaven", "Pellgate", "Thurnby"]) + rng.choice(["", " Works", " Group"])
    title = f"How {name()} saved a mill"
    body = [title] + [" ".join(rng.choice(SENTENCES).format(x=name()) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 7))]
    head = ["Skip to content", "Home", "About us", "Contact", "Log in"][: rng.randint(2, 5)] + ["We use cookies and similar tools to run this site."]
    lines = [(x, False) for x in head] + [(body[0], True), (f"Posted by {name()}", False), ("Share this article", False), ("", False)]
    for paragraph in body[1:]:
        lines.append((paragraph, True))
        if rng.random() < 0.3:
            lines += [("", False), ("See also: How a town saved its mill", False)]
    lines += [("All rights reserved. No part may be copied.", False), ("Related stories", False), (f"How {name()} lost a mill", False), ("Privacy notice", False), ("© 2024 Site", False)]
    attributes = json.dumps({"content": "\n".join(x for x, _ in lines), "title": title, "original_url": f"https://h/{n}/"})
    return attributes, {i for i, (_, keep) in enumerate(lines, 1) if keep}


def test_table(spark):
    pages = [make(n) for n in range(160)]
    rows = [(f"i{n}", "W/Site", a) for n, (a, _) in enumerate(pages)] * 2
    rows += [("null", "W/Site", None), ("cut", "W/Site", "{"), ("empty", "W/Site", '{"content": ""}'), ("blank", None, '{"content": "\\n \\n"}'), (None, "W/Site", pages[0][0]), ("long", "W/Site", json.dumps({"content": "word " * 200_000}))]
    df = spark.createDataFrame(rows, "id string, source string, attributes string").withColumn("line_no", F.lit("clash"))
    found = mainbody.main_body(df)
    got = [(r["id"], r["line_no"]) for r in found.collect()]
    expected = {(f"i{n}", k) for n, (_, kept) in enumerate(pages) for k in kept}
    mine = {x for x in got if x[0].startswith("i")}
    assert len(got) == len(set(got)) and len(mine & expected) > 0.97 * max(len(mine), len(expected))
    assert not {i for i, _ in got} & {"null", "cut", "empty", "blank", None}
    assert mainbody.body_texts(df).count() == len({i for i, _ in got})


def test_empty(spark):
    assert mainbody.main_body(spark.createDataFrame([], "id string, source string, attributes string")).count() == 0


def found_in(spark, rows, **options):
    got = mainbody.main_body(spark.createDataFrame(rows, "id string, source string, attributes string"), **options)
    return {(r["id"], r["line_no"]) for r in got.collect()}


def test_few_pages(spark):
    """A few pages have their bodies too.  One or two have nothing in common to tell furniture by: all of the body is found, and some furniture."""
    for n in (1, 2, 12):
        pages = [make(k) for k in range(n)]
        expected = {(f"i{k}", x) for k, (_, kept) in enumerate(pages) for x in kept}
        got = found_in(spark, [(f"i{k}", "W/Site", a) for k, (a, _) in enumerate(pages)])
        assert len(got & expected) > 0.95 * len(expected) and (n < 3 or len(got & expected) > 0.95 * len(got))


def test_long_pages_only(spark, monkeypatch):
    """Records too long to be trained on before shorter ones are trained on where there are no others, up to a total."""
    pages = [make(k) for k in range(130)]
    df = spark.createDataFrame([(f"i{k}", "W/Site", a) for k, (a, _) in enumerate(pages)], "id string, source string, attributes string")
    monkeypatch.setattr(mainbody, "SAMPLE_CHARS", 100)
    assert len(mainbody.sample_pages(df, 3000, "id", "source", "attributes")) == 130
    expected = {(f"i{k}", x) for k, (_, kept) in enumerate(pages) for x in kept}
    got = {(r["id"], r["line_no"]) for r in mainbody.main_body(df).collect()}
    assert len(got & expected) > 0.95 * max(len(got), len(expected))
    monkeypatch.setattr(mainbody, "SAMPLE_TOTAL", 10_000)
    assert 0 < len(mainbody.sample_pages(df, 3000, "id", "source", "attributes")) < 10
    assert len(found_in(spark, [("a", "W/Site", json.dumps({"content": "\n".join(["A long sentence that says something here."] * 9_000)}))])) == 9_000


def test_sample_among_records_without_content(spark):
    rows = [(f"i{k}", "W/Site", make(k)[0]) for k in range(60)] + [(f"n{k}", "W/Site", '{"title": "t"}') for k in range(600)]
    df = spark.createDataFrame(rows, "id string, source string, attributes string")
    assert len(mainbody.sample_pages(df, 50, "id", "source", "attributes")) == 50


def test_two_contents_of_one_id(spark):
    pages = [make(k) for k in (1, 2)]
    model = mainbody.train([mainbody.page_of(make(k)[0], "W/Site") for k in range(120)])
    df = spark.createDataFrame([("x", "W/Site", a) for a, _ in pages] * 2, "id string, source string, attributes string")
    bodies = {r["body"] for r in mainbody.body_texts(df, model=model).collect()}
    content = [json.loads(a)["content"].split("\n") for a, _ in pages]
    assert bodies == {"\n".join(c[k - 1] for k in sorted(kept)) for c, (_, kept) in zip(content, pages, strict=True)}


def test_decoding_is_best_and_consistent():
    rng = np.random.default_rng(1)
    for _ in range(40):
        parents = [np.zeros(1, int), np.array([0, 0]), np.array([0, 1, 1]), np.array([0, 0, 1, 2])]
        scores = [rng.normal(0, 2, len(p)) for p in parents]
        kept = mainbody.decode(scores, parents)
        log = lambda s, y: -np.logaddexp(0, -s if y else s)
        best, chosen = -np.inf, None
        for lines in itertools.product([0, 1], repeat=4):
            up = [np.array(lines)]
            for depth in (2, 1, 0):
                up.insert(0, np.array([max((up[0][c] for c in range(len(up[0])) if parents[depth + 1][c] == n), default=0) for n in range(len(parents[depth]))]))
            value = sum(log(s, y) for level, labels in zip(scores, up, strict=True) for s, y in zip(level, labels, strict=True))
            if value > best:
                best, chosen = value, lines
        assert tuple(kept.astype(int)) == chosen


def test_a_page_is_read_alone():
    """Features, and so lines, of a page don't depend on the pages around it."""
    pages = [mainbody.page_of(make(n)[0], "W/Site") for n in range(160)]
    pages[5:5] = [mainbody.Page(" \n", "", "site", ""), mainbody.Page("word. " * 40_000, "", "site", "")]
    model = mainbody.train(pages)
    together = mainbody.tree_of(mainbody.read_lines(pages, model.weights.tokens), pages, model.weights)
    page, number = mainbody.body_lines(model, pages)
    for i, p in enumerate(pages):
        alone = mainbody.tree_of(mainbody.read_lines([p], model.weights.tokens), [p], model.weights)
        if p.content.strip():
            assert np.array_equal(alone.features[0][0], together.features[0][i])
        assert mainbody.body_lines(model, [p])[1].tolist() == number[page == i].tolist()
    assert mainbody._running_max(np.array([0, 0, 1, 1, 1]), np.array([3e4, 1, -20, 0.1, 2])).tolist() == [-9, 3e4, -9, -9, 0.1]


def test_boosting_learns():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:3000], y[:3000], trees=40, depth=4)
    assert ((boosting.log_odds(model, x[3000:]) > 0) == y[3000:]).mean() > 0.97
    constant = boosting.fit(np.ones((50, 2)), np.zeros(50), trees=2)
    assert (boosting.log_odds(constant, np.ones((3, 2))) < 0).all()


def test_seed_labels():
    """Furniture is what the pages of a site repeat; what it is made of doesn't matter."""
    make_page = lambda k: Page(f"Xa\nXb\nThe title {'abcdefgh'[k]}\nXby A B | 1.2.202{k}{chr(10) + 'Risk' + 'abcdefgh'[k] if k % 2 else ''}\nA long sentence that says something{'abcdefgh'[k]} here.\n- {'abcdefgh'[k]} list item\n\nXbox\n{'abcdefgh'[k]} teaser that won\nXletter\n\nAnother long sentence that says something{'abcdefgh'[k]} here.\nXtags: a{'abcdefgh'[k]}, b\n{'abcdefgh'[k]} teaser at the end of it all.", f"The title {'abcdefgh'[k]}", "site", "", "A B")
    views, labels = learn_labels([make_page(k) for k in range(8)])
    expected = [False, False, True, False, True, True, True, None, False, False, False, None, True, False, False]
    assert labels == [expected[:4] + expected[5:], expected] * 4
    assert views.lines["site"]["xbox"] == "box" and views.heads["site"]["xtags"] == "tail"
    listing = Page("News\nThe teaser that won\nA long sentence that says […]\nMore", "Other", "site", "")
    assert not any(seed_labels(listing, views))
    assert seed_labels(Page("", "", "unknown", ""), learn_views([])) == [None]


def translated(n, words, sentences, site):
    """A page as `make` has it, in other words: furniture from `words`, prose from `sentences`."""
    rng = random.Random(n)
    name = lambda: rng.choice("Arvo Belka Cinta Dorva Elmi".split()) + rng.choice("bria lunda mosca tera vinci".split())
    menu, cookie, by, share, see, rights, box, more, foot = words
    title = f"{sentences[0].split()[0]} {name()} {name()} {n}"
    author = f"{name()} {name()}"
    lines = [(x, False) for x in menu[: rng.randint(3, 6)]] + [(cookie, False), (title, True), (f"{by} {author}", False), (share, False)]
    for _ in range(rng.randint(4, 8)):
        if rng.random() < 0.2:
            lines.append((f"{name()} {name()} {rng.choice('qwertz')}", True))
        lines.append((" ".join(rng.choice(sentences).format(x=name(), y=rng.randint(2, 900)) for _ in range(rng.randint(1, 4))), True))
        if rng.random() < 0.25:
            lines += [("", False), (f"{see}: {name()} {name()}", False)]
        if rng.random() < 0.15:
            lines += [(box, False)] + [(f"{name()} {name()} {name()}", False) for _ in range(3)] + [(menu[0], False)]
    lines += [(rights, False), (more, False)] + [(f"{name()} {name()} {name()}", False) for _ in range(rng.randint(1, 4))] + [(sentences[0].format(x=name(), y=1), False)] * rng.randint(0, 1) + [(foot, False)]
    attributes = json.dumps({"content": "\n".join(x for x, _ in lines), "title": title, "author": author, "original_url": f"https://{site}/{n}/"})
    return attributes, {i for i, (_, keep) in enumerate(lines, 1) if keep}


SITES = {
    "Piazza": (["Accedi", "Chi siamo", "Cronaca", "Economia", "Contatti", "Lavora con noi"], "Usiamo i biscotti per misurare le visite e mostrare annunci.", "Scritto da", "Condividi", "Leggi pure", "Riproduzione riservata, ogni diritto spetta al gruppo editoriale.", "I più letti", "Ti potrebbe interessare", "Torna su"),
    "Rynek": (["Zaloguj", "O nas", "Kraj", "Sport", "Kontakt", "Praca"], "Ta strona zapisuje pliki na urządzeniu, aby liczyć odwiedziny.", "Autor", "Podaj dalej", "Czytaj także", "Wszelkie prawa należą do wydawcy, kopiowanie tylko za zgodą.", "Najczęściej czytane", "Zobacz również", "Do góry"),
    "Gazete": (["Giriş", "Hakkımızda", "Gündem", "Spor", "İletişim", "Kariyer"], "Bu site ziyaretleri ölçmek için cihazda veri saklar ve okur.", "Yazan", "Paylaş", "Ayrıca okuyun", "Bu yayının her hakkı saklıdır, izinsiz hiçbir yerde kullanılamaz.", "En çok okunan", "Bunlar da var", "Yukarı çık"),
}
PROSE = {
    "Piazza": ["Il consiglio di {x} ha chiuso il teatro dopo una lunga verifica.", "Pochi a {x} credevano ancora alla notizia nel {y}.", "Secondo {x} il vecchio mulino vale ormai {y} milioni.", "Né {x} né il sindaco hanno voluto commentare il piano."],
    "Rynek": ["Rada miasta {x} zamknęła teatr po długiej kontroli.", "Niewielu ludzi w {x} wierzyło w tę wiadomość w {y} roku.", "Zdaniem {x} stary młyn jest dziś wart {y} milionów.", "Ani {x}, ani burmistrz nie chcieli mówić o tym planie."],
    "Gazete": ["{x} belediyesi uzun bir incelemeden sonra tiyatroyu kapattı.", "{x} kentinde çok az kişi bu habere {y} yılında inandı.", "{x} için eski değirmen bugün {y} milyon ediyor.", "Ne {x} ne de başkan bu plan için bir şey söyledi."],
}


def test_other_languages_and_furniture(spark):
    """Sites in languages and with furniture that nothing in the library names."""
    pages = {f"{s}{n}": (s, *translated(n * 3 + k, SITES[s], PROSE[s], s)) for k, s in enumerate(SITES) for n in range(90)}
    got = found_in(spark, [(i, f"W/{s}", a) for i, (s, a, _) in pages.items()])
    expected = {(i, k) for i, (_, _, kept) in pages.items() for k in kept}
    for s in SITES:
        mine, true = ({x for x in y if x[0].startswith(s)} for y in (got, expected))
        assert len(mine & true) > 0.95 * max(len(mine), len(true)), (s, len(mine), len(true), len(mine & true))


def test_unseen_furniture():
    """A trained model on a site it has not seen, whose furniture it can't know: told by place and form."""
    known = [mainbody.page_of(translated(n * 2 + k, SITES[s], PROSE[s], s)[0], f"W/{s}") for k, s in enumerate(("Piazza", "Rynek")) for n in range(120)]
    model = mainbody.train(known)
    fresh = [translated(1000 + n, SITES["Gazete"], PROSE["Piazza"], "Gazete") for n in range(60)]
    page, number = mainbody.body_lines(model, [mainbody.page_of(a, "W/Gazete") for a, _ in fresh])
    got, expected = set(zip(page.tolist(), number.tolist(), strict=True)), {(i, k) for i, (_, kept) in enumerate(fresh) for k in kept}
    print(len(got), len(expected), len(got & expected))
    assert len(got & expected) > 0.8 * len(expected) and len(got & expected) > 0.75 * len(got)


def test_model_is_kept(spark, tmp_path):
    model = mainbody.train([mainbody.page_of(make(k)[0], "W/Site") for k in range(120)])
    mainbody.save(model, spark, f"file://{tmp_path}/model")
    again = mainbody.load(spark, f"file://{tmp_path}/model")
    pages = [mainbody.page_of(make(k)[0], "W/Site") for k in range(200, 230)]
    assert all(np.array_equal(a, b) for a, b in zip(mainbody.body_lines(model, pages), mainbody.body_lines(again, pages), strict=True))


def test_lines_of_decoration():
    """Separators in trained pages: lines, but not of the body; blank is the same for labels and for lines read."""
    marks = ["***", "* * *", "---", "•", "→", "…", "(12)", "»", "·", "\u200b***", "\u200b", "\u00ad \u2060", " \t", "\u3000", "\x1c", "\u00a8", "!", "..."]
    pages = []
    for n in range(40):
        record = json.loads(make(n)[0])
        content = record["content"].split("\n")
        for k, mark in enumerate(marks):
            content.insert((7 * k + n) % len(content), mark)
        pages.append(mainbody.Page("\n".join(content), record["title"], "site", record["original_url"]))
    for p, labels in zip(pages, learn_labels(pages)[1], strict=True):
        assert [i for i, x in enumerate(labels, 1) if x is not None] == mainbody.read_lines([p], {}).number.tolist()
    assert len(mainbody.body_lines(mainbody.train(pages), pages)[0])
    assert seed_labels(Page("***\n•\n---\n(12)\n \n", "t", "site", ""), learn_views([])) == [False] * 4 + [None] * 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no tables")
def test_held_out_accuracy():
    """Trained on some pages, right on others, measured against the seed labels."""
    import pandas as pd

    table = pd.read_parquet("/root/testdata/sf0.1/unified_all_cms_content.parquet", columns=["id", "source", "attributes"]).drop_duplicates("id").head(2200)
    pages = [p for p in (mainbody.page_of(a, s) for a, s in zip(table.attributes, table.source, strict=True)) if p]
    model = mainbody.train(pages[:1600])
    held = pages[1600:]
    page, number = mainbody.body_lines(model, held)
    got = set(zip(page.tolist(), number.tolist(), strict=True))
    expected = {(i, n) for i, labels in enumerate(learn_labels(pages)[1][1600:]) for n, keep in enumerate(labels, 1) if keep}
    assert len(got & expected) > 0.985 * max(len(got), len(expected))


def test_numbers_of_an_id(spark):
    """Versions of an id together, each number once."""
    pages = [make(k) for k in (1, 2)]
    model = mainbody.train([mainbody.page_of(make(k)[0], "W/Site") for k in range(120)])
    df = spark.createDataFrame([("x", "W/Site", a) for a, _ in pages] * 2 + [("y", "W/Site", pages[0][0]), ("z", "W/Site", None)], "id string, source string, attributes string")
    got = [(r["id"], r["line_no"]) for r in mainbody.body_numbers(df, model=model).collect()]
    every = {(r["id"], r["line_no"]) for r in mainbody.main_body(df, model=model).collect()}
    assert len(got) == len(set(got)) and set(got) == every and {i for i, _ in got} == {"x", "y"}


def test_sample_of_many_sites(spark, monkeypatch):
    """Like parts of the sites; more sites than pages, and sites without content, end as well."""
    monkeypatch.setattr(mainbody, "SAMPLE_SITES", 8)
    rows = [(f"i{k}", f"W/S{k % 12}", make(k)[0]) for k in range(240)] + [(f"n{k}", "W/S1", "{}") for k in range(50)]
    df = spark.createDataFrame(rows, "id string, source string, attributes string")
    pages = mainbody.sample_pages(df, 80, "id", "source", "attributes")
    sizes = Counter(p.site for p in pages)
    assert 60 <= len(pages) <= 80 and len(sizes) == 8 and max(sizes.values()) <= 20
    assert 0 < len(mainbody.sample_pages(df, 5, "id", "source", "attributes")) <= 5
