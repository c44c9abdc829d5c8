import random
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import spam

ARTICLE = "The board of the old theatre closed its doors after a long review. Few people in town had expected the news, and none of them was ready for it. "

# What a corpus of English texts yields (see test_connecting_words_of_the_corpus); a page of one repeated sentence can't be told without.
WORDS = frozenset("a after and as at before by every few for in into is it its none not of or the them to was what why will with".split())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=16))
def test_automaton(tokens):
    times = Counter(tokens)
    tokens = [t if times[t] > 1 else -1 for t in tokens]
    longest, often, steady = spam.repeats(tokens, 3)
    n = len(tokens)
    seen = Counter(tuple(tokens[i:j]) for i in range(n) for j in range(i + 1, n + 1) if -1 not in tokens[i:j])
    for end in range(n):
        best = max((size for size in range(1, end + 2) if seen.get(tuple(tokens[end - size + 1 : end + 1]), 0) > 1), default=0)
        assert steady[end] == max((size for size in range(1, end + 2) if seen.get(tuple(tokens[end - size + 1 : end + 1]), 0) > 2), default=0)
        assert longest[end] == best and (not best or often[end] == seen[tuple(tokens[end - best + 1 : end + 1])])


def spammy(kind):
    random.seed(kind)
    nouns, extras = ["wind farm", "running shoes", "hotel voucher"], ["cheap", "best", "near me", "buy", "review", "free delivery"]
    pick = lambda: (random.choice(nouns), random.choice(extras))
    parts = {
        "commas": lambda n, e: f"{e} {n}, ", "plain": lambda n, e: f"{n} {e} ", "sentences": lambda n, e: f"{e.capitalize()} {n}{random.choice('.!?')} ", "hashtags": lambda n, e: f"#{(e + n).replace(' ', '')} ",
        "urls": lambda n, e: f"https://some-shop.example/{n.replace(' ', '-')}/{random.randint(1, 9999)}\n", "anchors": lambda n, e: f'<a href="www.some-shop.example/{random.randint(1, 999)}">{n}</a> ',
        "markdown": lambda n, e: f"[{n} {e}](https://x.example/{random.randint(1, 999)})\n", "products": lambda n, e: f"{n} | {random.choice('SML')} | SKU{random.randint(1000, 99999)} | {e}\n",
        "places": lambda n, e: f"{n} {random.choice('ABCDEFGHIJ')}ville\n", "listing": lambda n, e: f"{n} – {e} – shop{random.randint(1, 99)}.example\n",
    }
    return "".join(parts[kind](*pick()) for _ in range(40))


KINDS = ["commas", "plain", "sentences", "hashtags", "urls", "anchors", "markdown", "products", "places", "listing"]


@pytest.mark.parametrize("kind", KINDS)
def test_spam(kind):
    text = spammy(kind)
    assert spam.judge(text).share > 0.9
    assert spam.judge(text, WORDS).share > 0.9
    assert spam.judge(text + "\n" + ARTICLE, WORDS).share > 0.5
    assert spam.judge(ARTICLE * 3 + "\n" + text[:150], WORDS).share < 0.5


@pytest.mark.parametrize(
    "text",
    [
        ARTICLE * 2, None, "", " \n ", "word", "&nbsp;",
        "\n".join(f"{i}. {a}ton Rovers  {i * 7 % 30}  {i % 9}:{i % 5}  {i * 13 % 99}" for i, a in enumerate("ABCDEFGHIJKLMNOP", 1)),
        "\n".join(f"{i:02d}:{i * 7 % 60:02d}  {a}ford – {b}ham" for i, (a, b) in enumerate(zip("ABCDEFGHIJ", "KLMNOPQRST"))),
        "\n".join(f"- {x}" for x in ("a cautious archive", "the theatre in Oxford", "Ann Smith as adviser", "12 new places at the works", "one farm for every district")),
        "\n".join(f"{n}: {s}" for n, s in (("Ann", "Why did the board close the theatre?"), ("Bob", "It was too old, and the roof was leaking."), ("Ann", "What will happen to the staff?"))),
        ARTICLE + "See https://x.example/a and www.y.example for more.", "Refrain of the old song about the town and its people by the sea.\n" * 6,
    ],
)
def test_no_spam(text):
    assert spam.judge(text, WORDS).share <= 0.5


def test_invisible_characters_and_entities_change_nothing():
    text = spammy("commas")
    hidden = text.replace("farm", "fa" + chr(0x200B) + "rm", 7).replace("shoes", "sho&shy;es", 5)
    assert spam.judge(hidden).keywords > 0.9 * spam.judge(text).keywords


def test_long_text():
    assert spam.judge("cheap wind farm, " * 30_000).share == 1.0
    assert spam.judge("x" * 300_000).share == 0.0


def test_table(spark):
    df = spark.createDataFrame([(1, spammy("commas")), (2, ARTICLE), (3, None), (3, None), (None, "x")], "doc_id long, text string").withColumnRenamed("x", "share")
    got = sorted(((r["document"], r["spam"]) for r in spam.spam_measures(df).collect()), key=str)
    assert got == [(1, True), (2, False), (3, False), (3, False), (None, False)]
    assert spam.spam_measures(df.limit(0)).count() == 0


# Prose that repeats a phrase, in languages of which the library knows nothing.
PROSE = {
    "sk": "Ministerstvo vnútra Slovenskej republiky v pondelok oznámilo, že hranice zostanú otvorené. Podľa ministerstva vnútra Slovenskej republiky sa počet žiadostí v máji znížil o tretinu. Hovorca povedal, že ministerstvo vnútra Slovenskej republiky pripravuje nový zákon, ktorý má platiť od januára. Opozícia s tým nesúhlasí a žiada, aby ministerstvo vnútra Slovenskej republiky zverejnilo všetky údaje. Starostovia obcí pri hranici sa boja, že na nich ostane celá práca. Ministerstvo vnútra Slovenskej republiky im preto sľúbilo viac peňazí a ľudí.",
    "pl": "Ministerstwo spraw zagranicznych podało w piątek, że rozmowy potrwają do końca miesiąca. Zdaniem ministerstwa spraw zagranicznych obie strony są bliskie porozumienia. Rzecznik ministerstwa spraw zagranicznych nie chciał jednak mówić o szczegółach. W rozmowach biorą udział także eksperci, których ministerstwo spraw zagranicznych zaprosiło z uczelni. Na razie nie wiadomo, kiedy dokument trafi do sejmu i czy posłowie go poprą. Ministerstwo spraw zagranicznych liczy na to, że stanie się to jeszcze przed wakacjami.",
    "ru": "Министерство иностранных дел сообщило в пятницу, что переговоры продлятся до конца месяца. По мнению министерства иностранных дел, стороны близки к соглашению. Представитель министерства иностранных дел не стал говорить о деталях. В переговорах участвуют и эксперты, которых министерство иностранных дел пригласило из университетов. Пока неясно, когда документ попадёт в парламент и поддержат ли его депутаты. Министерство иностранных дел надеется, что это случится ещё до лета.",
    "it": "La Banca centrale europea ha deciso giovedì di lasciare i tassi al livello di prima. Secondo la Banca centrale europea i prezzi saliranno ancora, ma meno che nel 2022. Il governatore ha detto che la Banca centrale europea resterà prudente fino a quando i salari non si fermeranno. Per le famiglie che hanno un mutuo la scelta della Banca centrale europea non cambia molto. Gli analisti pensano invece che la Banca centrale europea dovrà muoversi già in autunno.",
    "tr": "Türkiye Cumhuriyet Merkez Bankası perşembe günü faizi değiştirmedi. Ekonomistler Türkiye Cumhuriyet Merkez Bankası'nın bu kararı için farklı şeyler söylüyor. Bazıları Türkiye Cumhuriyet Merkez Bankası çok geç kaldı diyor, bazıları ise bunun doğru olduğunu düşünüyor. Türkiye Cumhuriyet Merkez Bankası açıklamasında fiyatların yıl sonuna kadar düşeceğini yazdı. Ama pazarda alışveriş yapan insanlar buna pek inanmıyor ve her hafta daha az şey aldıklarını anlatıyor.",
    "fi": "Suomen ulkoministeriö kertoi perjantaina, että neuvottelut jatkuvat kuun loppuun. Suomen ulkoministeriö sanoo osapuolten olevan jo lähellä sopua. Kukaan ei silti tiedä, milloin paperi tulee eduskuntaan ja hyväksyvätkö kansanedustajat sen. Suomen ulkoministeriö on kutsunut mukaan myös tutkijoita, mutta heidän nimiään ei ole kerrottu. Jos kaikki menee hyvin, Suomen ulkoministeriö voi julkaista tekstin ennen kesää.",
    "hu": "A Magyar Nemzeti Bank csütörtökön nem változtatott a kamaton. A Magyar Nemzeti Bank szerint az árak lassabban nőnek, mint tavaly, de a cél még messze van. Az elemzők úgy látják, hogy a Magyar Nemzeti Bank ősszel léphet majd. A kormány ennél többet várt, és ezt nem is titkolta. A miniszter azt mondta, hogy a Magyar Nemzeti Bank túl óvatos, és ezzel árt a gazdaságnak.",
    "el": "Το υπουργείο Εξωτερικών ανακοίνωσε την Παρασκευή ότι οι συνομιλίες θα κρατήσουν ως το τέλος του μήνα. Το υπουργείο Εξωτερικών λέει ότι οι δύο πλευρές είναι κοντά. Κανείς δεν ξέρει όμως πότε το κείμενο θα φτάσει στη Βουλή και αν θα το στηρίξουν οι βουλευτές. Το υπουργείο Εξωτερικών έχει καλέσει και καθηγητές από τα πανεπιστήμια. Αν όλα πάνε καλά, το υπουργείο Εξωτερικών θα το δημοσιεύσει πριν από το καλοκαίρι.",
    "id": "Bank Indonesia pada hari Kamis tidak mengubah suku bunga. Menurut Bank Indonesia harga masih akan naik, tetapi tidak secepat tahun lalu. Para ahli menilai bahwa Bank Indonesia baru akan bergerak pada musim gugur. Pemerintah berharap lebih dari itu dan tidak menyembunyikannya. Seorang menteri berkata bahwa Bank Indonesia terlalu hati-hati dan hal itu merugikan orang yang ingin membeli rumah.",
    "zh": "外交部星期五表示，谈判将持续到月底。外交部认为双方已经接近达成协议。不过外交部发言人没有透露细节。外交部还邀请了大学里的专家参加谈判。目前还不清楚文件什么时候会提交议会，也不知道议员是否会支持。外交部希望这件事能在夏天之前完成。",
    "ar": "قالت وزارة الخارجية يوم الجمعة إن المحادثات ستستمر حتى نهاية الشهر. وترى وزارة الخارجية أن الطرفين قريبان من الاتفاق. لكن المتحدث باسم وزارة الخارجية لم يرغب في الحديث عن التفاصيل. ويشارك في المحادثات خبراء دعتهم وزارة الخارجية من الجامعات. ولا يعرف أحد متى يصل النص إلى البرلمان وهل يدعمه النواب. وتأمل وزارة الخارجية أن يحدث ذلك قبل الصيف.",
    "sv": "Riksbanken lämnade på torsdagen räntan som den var. Enligt den svenska riksbanken stiger priserna fortfarande, men inte lika snabbt som i fjol. Många tror att den svenska riksbanken rör sig först i höst. Regeringen hade hoppats på mer och gjorde ingen hemlighet av det. En minister sade att den svenska riksbanken är för försiktig och att det skadar dem som vill köpa hus.",
}
STUFFED = {
    "zh stuff": "手机壳批发 便宜手机壳 手机壳厂家 手机壳价格 手机壳定制 手机壳批发 便宜手机壳 手机壳网购 手机壳厂家 手机壳价格 手机壳定制 手机壳批发 便宜手机壳 手机壳网购手机壳批发 便宜手机壳 手机壳厂家 手机壳价格 手机壳定制 手机壳批发 便宜手机壳 手机壳网购 手机壳厂家 手机壳价格 手机壳定制 手机壳批发 便宜手机壳 手机壳网购手机壳批发 便宜手机壳 手机壳厂家 手机壳价格 手机壳定制 手机壳批发 便宜手机壳 手机壳网购 手机壳厂家 手机壳价格 手机壳定制 手机壳批发 便宜手机壳 手机壳网购",
    "zh unspaced": "手机壳批发便宜手机壳手机壳厂家手机壳价格手机壳定制手机壳批发便宜手机壳手机壳网购手机壳厂家手机壳价格手机壳定制手机壳批发便宜手机壳手机壳网购手机壳批发便宜手机壳手机壳厂家手机壳价格手机壳定制手机壳批发便宜手机壳手机壳网购手机壳厂家手机壳价格手机壳定制手机壳批发便宜手机壳手机壳网购",
    "ja": "格安ホテル予約東京格安ホテル予約大阪格安ホテル予約京都格安ホテル予約名古屋格安ホテル予約福岡格安ホテル予約札幌格安ホテル予約東京格安ホテル予約大阪格安ホテル予約京都格安ホテル予約名古屋格安ホテル予約福岡格安ホテル予約札幌格安ホテル予約東京格安ホテル予約大阪格安ホテル予約京都格安ホテル予約名古屋格安ホテル予約福岡格安ホテル予約札幌",
    "sk stuff": "lacné topánky online, kúpiť topánky, topánky zľava, dámske topánky lacno, topánky výpredaj, lacné topánky Bratislava, topánky eshop, kúpiť topánky online, topánky zľava, lacné topánky lacné topánky online, kúpiť topánky, topánky zľava, dámske topánky lacno, topánky výpredaj, lacné topánky Bratislava, topánky eshop, kúpiť topánky online, topánky zľava, lacné topánky ",
}


@pytest.mark.parametrize("language", PROSE)
def test_prose_of_many_languages(language):
    assert spam.judge(PROSE[language]).share < 0.3
    assert spam.judge(PROSE[language], frozenset("a the of in de la le und die".split())).share < 0.3


@pytest.mark.parametrize("kind", STUFFED)
def test_stuffing_of_many_languages(kind):
    assert spam.judge(STUFFED[kind]).share > 0.9


@pytest.mark.parametrize("part", ["x-", "a.b-", "<a " + "href" * 50, "<a href ", "[", "[x](", ".", "a.", "www.", "…'", "#", "x'", "http://", "。", "<", "-", "x.y/"])
def test_patterns_are_linear(part):
    seconds = []
    for size in (100_000, 800_000):
        start = time.perf_counter()
        spam.judge(part * (size // len(part)) + "z")
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < max(0.5, 24 * seconds[0])  # quadratic would be 64


def test_undecided_pages_are_no_spam():
    """Without measuring, the decision is the same."""
    pages = [spammy(k) for k in KINDS] + [ARTICLE * 3, "", None] + list(PROSE.values()) + [spammy(k)[:200] + "\n" + ARTICLE for k in KINDS]
    for page in pages:
        quick = spam.judge(page, frozenset(), measure=False)
        assert (quick is not None and quick.share > spam.SHARE) == (spam.judge(page).share > spam.SHARE)


def naive_connecting(names):
    """Words that recur, and of whose neighbours enough differ on either side; each unit once."""
    units: dict[tuple, None] = {}
    unit: list[str] = []
    for w in names:
        if w:
            unit.append(w)
        else:
            units[tuple(unit)] = None
            unit = []
    padded = ["", *(w for u in units for w in (*u, ""))]
    out = set()
    for w in set(names) - {""}:
        at = [i for i, x in enumerate(padded) if x == w]
        if len(at) > 1 and not any(map(str.isdigit, w)) and all(len({padded[i + k] for i in at}) >= spam.DIVERSE * len(at) for k in (-1, 1)):
            out.add(w)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["red", "shoe", "in", "Town", "7", ".\n", "sale"]), max_size=40))
def test_connecting(parts):
    words = spam.read_words(" ".join(parts))
    assert words is None or spam.connecting(words) == naive_connecting(words.names)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["red", "shoe", "in", "Town", "7", ".\n", "sale", "a1", "x. ", "\u3002"]), max_size=40).map(" ".join), max_size=5))
def test_counts_agree_with_pages(texts):
    words, yes, held = spam.count_connecting([*texts, None])
    pages = [w for w in map(spam.read_words, texts) if w]
    expected = Counter(w for p in pages for w in spam.connecting(p))
    assert {w: n for w, n in zip(words, yes.tolist()) if n} == dict(expected)
    assert dict(zip(words, held.tolist())) == {"": 0} | dict(Counter(w for p in pages for w in p.times))


def test_connecting_words_of_the_corpus(spark):
    """Counted over all documents, whatever the language's part of them."""
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    sentence = lambda words: " ".join(f"{name()} {rng.choice(words)}" for _ in range(5)) + f" {name()}."
    english = [" ".join(sentence(["the", "of", "and", "to"]) for _ in range(6)) for _ in range(60)]
    other = [" ".join(sentence(["ta", "wo", "i", "na"]) for _ in range(6)) for _ in range(6)]
    topics = [f"{name()} {w} {name()}. {name()} {w} {name()}." for w in ["museum"] * 4] + [f"{name()} museum {name()}." for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in [*english, *other, *topics, None, ""]], "text string")
    assert spam.connecting_words(df) == {"the", "of", "and", "to", "ta", "wo", "i", "na"}
    assert spam.connecting_words(df.limit(0)) == frozenset()
    only = spam.spam_measures(spark.createDataFrame([(1, spammy("commas")), (2, ARTICLE), (None, spammy("plain"))], "doc_id long, text string"), spam_only=True)
    assert sorted((r["document"] or 0, r["spam"]) for r in only.collect()) == [(0, True), (1, True)]
