"""Personal information, markup, leakage and subjects."""

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm import leakage, markup, pii, subjects

KEY = b"k" * 32


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("mail me: jo.smith+x@a-b.example.", "email", "jo.smith+x@a-b.example"), ("(a77 [at] post[dot]test)", "email", "a77 [at] post[dot]test"), ("reach jo AT post DOT test now", "email", "jo AT post DOT test"),
        ("Dial 07700 900 123, then", "phone", "07700 900 123"), ("fax (512) 555-0103 is", "phone", "(512) 555-0103"), ("at +44 7700 900123.", "phone", "+44 7700 900123"), ("on 0 7 7 0 0 9 0 0 6 3 4 before", "phone", "0 7 7 0 0 9 0 0 6 3 4"),
        ("call two two two five five five zero one four six", "phone", "two two two five five five zero one four six"), ("number QQ 12 34 56 C did", "id_number", "QQ 12 34 56 C"), ("SSN 912-34-5678 and", "id_number", "912-34-5678"),
        ("Licence VH7817 83772 is", "id_number", "VH7817 83772"), ("ID HN-1234-5678-90", "id_number", "HN-1234-5678-90"), ("went to 1509 W. Hazel Rd instead", "street_address", "1509 W. Hazel Rd"), ("to 16B Tanner Ave. as", "street_address", "16B Tanner Ave."),
        ("Pick it up, Flat 3, Hazelgasse 58, ring", "street_address", "Hazelgasse 58"), ("at 49A Ferry Street, come", "street_address", "49A Ferry Street"), ("by Dr. Noor Hale in spring", "person_name", "Noor Hale"), ("Signed, Anna B. Meyer-Holt", "person_name", "Anna B. Meyer-Holt"),
        ("According to Hale, Noor the", "person_name", "Hale, Noor"), ("My ex, noor hale, left", "person_name", "noor hale"), ("nurse Xylo Hale-Quist remembered", "person_name", "Xylo Hale-Quist"),
    ],
)
def test_pii_kinds(text, kind, found):
    assert [(k, text[a:b]) for a, b, k in pii.find_pii(text)] == [(kind, found)]


@pytest.mark.parametrize("text", ["", None, "Order 4471-2290 came", "Lot 8832-114 was", "128/84 on 2021-03-14", "Model SN-2231-99 at 555 mg", "Version 3.11.2", "down Melody Lane and back", "I tested 4000 8000 12000 Hz", "u/soft_static posted", "By Thursday, my landlord", "28 out of 38 when the street empties", "Meet me @ the pharmacy"])
def test_no_pii(text):
    assert pii.find_pii(text) == []


@given(st.text(alphabet="0123456789ABCXYZabc -+()", min_size=1, max_size=24))
@settings(max_examples=150, deadline=None)
def test_pseudonyms_keep_format_and_invert(text):
    out = pii.permute_text(text, KEY)
    assert pii.permute_text(out, KEY, inverse=True) == text
    assert [c.isdigit() for c in out] == [c.isdigit() for c in text] and [c.isupper() for c in out] == [c.isupper() for c in text]


def test_pseudonyms_are_a_permutation_and_linked():
    assert len({pii.permute(v, 7, 11, KEY) for v in range(77)}) == 77
    assert pii.placeholder("phone", "+44 7700 900123", KEY) == pii.placeholder("phone", "07700 900 123", KEY) != pii.placeholder("phone", "07700 900 124", KEY)
    day = pii.permute_date("2001-02-03", KEY)
    assert day != "2001-02-03" and pii.permute_date(day, KEY, inverse=True) == "2001-02-03" and pii.permute_date("1700-01-01", KEY) == "1700-01-01"


@pytest.mark.parametrize("raw", ["07700 900 123", "(512) 555-0103", "+44 20 7946 0958", "+49 30 901820123"])
def test_phone_pseudonyms_stay_in_their_plan(raw):
    number = pii.canonical("phone", raw)
    other = pii.permute_phone(number, KEY)
    assert other != number and pii.permute_phone(other, KEY, inverse=True) == number and len(other) == len(number)
    assert other[:3] == number[:3] and (raw.startswith("+49") or pii._phone(other, other))


@pytest.mark.parametrize("raw,pattern", [("1984-03-12", r"\[birth_date:\d{4}-\d\d-\d\d\]"), ("12/03/1984", r"\[birth_date:\d\d/\d\d/\d{4}\]"), ("3 March 1984", r"\[birth_date:\d{1,2} [A-Z][a-z]+ \d{4}\]")])
def test_birth_dates(raw, pattern):
    text = f"I was born on {raw}, in spring"
    clean = pii.replace_pii(text, pii.find_pii(text), KEY)
    assert re.fullmatch(r"I was born on " + pattern + r", in spring", clean) and raw not in clean
    assert pii.find_pii("born on 1984-02-31") == [] and pii.find_pii("seen on 1984-03-12") == []


def test_names_by_shape_and_context():
    names = lambda text: [text[a:b] for a, b, k in pii.find_pii(text) if k == "person_name"]
    assert names("Then Theresa May told me so") == ["Theresa May"] and names("with John Day, he said") == ["John Day"]
    assert names("It was Zbigniew Kowalczyk and Siobhan Gallagher said no") == ["Zbigniew Kowalczyk", "Siobhan Gallagher"]
    assert names("My dentist Zbigniew Kowalczyk was kind") == ["Zbigniew Kowalczyk"] and names("theresa may tell") == []


def test_numbers_of_things_and_short_ids():
    assert pii.find_pii("model mg1234567 on sale, invoice 912345678") == []
    assert [k for _, _, k in pii.find_pii("patient id KL-4471 it is")] == ["id_number"]
    assert [k for _, _, k in pii.find_pii("\u0130 asked anna meyer")] == ["person_name"]


def test_scrub_rows(spark):
    long = "word " * 50_000 + "mail a@b.test"
    rows = [(1, None, "z"), (2, "", "z"), (3, "Dial 07700900123, bye", "z"), (3, "Dial 07700900123, bye", "z"), (4, long, "z")]
    df = spark.createDataFrame(rows, "id int, body string, clean string")
    got = pii.scrub(df, {"id": "id", "text": "body"}, key="x").orderBy("id").collect()
    assert [r.id for r in got] == [1, 2, 3, 3, 4] and got[0].clean is None and got[1].clean == ""
    assert got[2].clean.startswith("Dial [phone:") and got[2].clean.endswith("], bye") and got[2].clean == got[3].clean
    assert got[4].findings[0].kind == "email" and pii.scrub(df.limit(0), {"id": "id", "text": "body"}, key="x").count() == 0


MARKED = {
    "html": ["<p>x</p>", "a &amp; b", "I <b>am</b> so", "&#39;x&#39;", "<!-- imported -->", '<a href="http://x.test">y</a>'],
    "markdown": ["# Head", "Head\n=====\n", "a **b c** d", "a _b c_ d", "a ~~b~~ c", "a `b c` d", "x\n\n- one\n- two", "x\n\n1. one", "> quote", "a [b](https://x.test) c", "```\ncode\n```", "| a | b |\n|---|---|\n| 1 | 2 |", "x\n\n    code here"],
    "wiki": ["See [[Buzz]].", "a [[Long|short]] b", "x.{{cite|page=1}} y", "== Head ==", "a '''b''' c", "{| class=\"x\"\n|-\n| a || b\n|}", "a [https://x.test b c] d"],
    "latex": [r"a \emph{b} c", r"$$ x = \frac{1}{2} $$", r"so \(f_0 = 2\) fits", r"\begin{itemize}\item a\end{itemize}", r"level $L = 3\,\mathrm{dB}$", r"\section*{A}"],
}
PLAIN = ["", None, "5 * 4 * 30", "sleep_log and soft_static", "x < y then", "love <3 you", "$5 a night and \\o/ ok", "$40 here and $95", r"C:\audio\loops", "Q&A on it", "7/10 & would", "#1 complaint", "2^10 samples -- no", "{notch} (-_-) again", "~20 min, ^ this", "[about] 3:1", "<40 dB and > 60 dB", "10-12-8"]


@pytest.mark.parametrize("kind,text", [(k, t) for k, ts in MARKED.items() for t in ts])
def test_markup_kinds(kind, text):
    assert markup.kinds_of(text) == [kind]


@pytest.mark.parametrize("text", PLAIN)
def test_no_markup(text):
    assert markup.clean_text(text) == (text, [])


def test_clean_text_keeps_structure():
    for text in ("<h2>Top</h2><p>Some <b>text</b> &amp; more.</p><ul><li>one</li><li>two</li></ul><pre><code>x = 1\ny = 2</code></pre>", "Top\n---\n\nSome **text** & more.\n\n* one\n* two\n\n```\nx = 1\ny = 2\n```", "== Top ==\nSome '''text''' & more.\n\n- one\n- two\n\n```\nx = 1\ny = 2\n```"):
        assert markup.clean_text(text)[0] == "## Top\n\nSome text & more.\n\n- one\n- two\n\n```\nx = 1\ny = 2\n```"
    assert markup.clean_text(r"\section{Top}" + "\n" + r"About 5\% of $$ x = \frac{1}{2} $$ and \emph{that}.")[0] == "## Top\n\nAbout 5% of\n\n$$x = \\frac{1}{2}$$\n\n and that."


def test_nesting_has_no_limit():
    assert markup.clean_text("x " + r"\emph{a " * 50 + "z" + "}" * 50)[0] == "x " + "a " * 50 + "z"
    assert markup.clean_text("x {{a|" * 50 + "}}" * 50 + " '''y'''")[0].strip() == "x y"
    assert markup.clean_text(r"see \href{https://x.test}{the \textbf{page}} now")[0] == "see the page now"
    assert markup.clean_text("<ol><li>one<li>two</ol><ul><li>three</ul>")[0] == "1. one\n2. two\n\n- three"


@pytest.mark.parametrize("text", ["```\n\ue0000\ue000 \ue0001\ue000 \ue009\n```", "\ue0009\ue000 **b c** \ue001x\ue002 \ue003a"])
def test_private_signs_survive(text):
    clean = markup.clean_text(text)[0]
    assert [c for c in clean if "\ue000" <= c <= "\uf8ff"] == [c for c in text if "\ue000" <= c <= "\uf8ff"]


HARD = ["<!-- ", "<pre>", "<a ", "<li ", "<ref>", "<!doctype ", "<script>", "[", "[[", "![", "[a](<", "{{", "\\(", "\\[", "\\ab[", "\\emph{", "$$", "**", "`", "__", "<http://", "[http://a ", "\\begin{align}", "''", "= ", "| ", "- ", "~~", "&a", "<td>", " "]


@pytest.mark.parametrize("sign", HARD)
def test_no_text_takes_quadratic_time(sign):
    for text in (sign * 20_000, "<b>x</b> '''y''' \\emph{z} **u v** " + sign * 20_000, (sign * 20_000) + "\n---\n"):
        start = time.process_time()
        markup.clean_text(text)
        assert time.process_time() - start < 4
    start = time.process_time()
    markup.clean_text("word " * 12_000 + "\n---\n")
    assert time.process_time() - start < 1


def test_block_rules():
    good = "The noise was there and it is what I hear when I go to bed, so that we have to talk about it with all of them. " * 3
    links = "".join(f'<a href="#">Menu item {i}</a> ' for i in range(8))
    page = f"<div>{links}</div><p>{good}</p><p>Short line here.</p><p>{good}</p><div>{links}</div><p>Contact imprint</p>"
    clean = markup.clean_text(page)[0]
    assert "Menu item" not in clean and "Short line here." in clean and "Contact imprint" not in clean


def test_strip_markup_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "**a b**", 0), (3, "**a b**", 0), (4, "x " * 60_000 + "<b>y</b>", 0)], "id int, body string, kinds int")
    got = markup.strip_markup(df, {"id": "id", "text": "body"}).orderBy("id").collect()
    assert [(r.clean, r.kinds) for r in got][:4] == [(None, []), ("", []), ("a b", ["markdown"]), ("a b", ["markdown"])] and got[4].kinds == ["html"]


WORDS = [f"w{i}" for i in range(400)]


def test_held_stretches():
    rng = random.Random(5)
    item = rng.sample(WORDS, 60)
    noise = [f"n{i}" for i in range(50)]
    assert leakage.held(noise + item + noise, item) == 60
    assert leakage.held(noise + item[10:28] + noise, item) == 18 and leakage.held(noise + item[10:27] + noise, item) == 0
    one = item[10:30]
    assert leakage.held(noise + one[:9] + ["zz"] + one[10:] + noise, item) == 20 and leakage.held(noise + one[:9] + one[10:] + noise, item) == 20
    assert leakage.held(noise + [w if i % 4 else "zz" for i, w in enumerate(one)] + noise, item) == 0
    assert leakage.held(noise + list(reversed(item)) + noise, item) == 0 and leakage.held([], item) == 0


def test_markup_inside_a_stretch_may_be_long():
    item = WORDS[:30]
    doc = " ".join(item[5:15]) + ' <span style="' + "x" * 900 + '">' + " ".join(item[15:25])
    assert leakage.held(leakage.plain_words(doc), item) == 20


def test_prefix_join_against_exhaustive_search():
    rng = random.Random(11)
    small = WORDS[:120]
    rows = [(i, " ".join(rng.choice(small) for _ in range(rng.randint(15, 70)))) for i in range(25)]
    block = leakage._Items(rows, leakage.WINDOW, leakage.ERRORS)
    docs = []
    for _ in range(250):
        doc = [rng.choice(small) for _ in range(rng.randint(10, 90))]
        for i in rng.sample(range(25), rng.choice([0, 1, 2])):
            words = rows[i][1].split()
            a = rng.randrange(len(words))
            part = words[a : a + rng.randint(12, 50)]
            for _ in range(rng.randint(0, len(part) // 7)):
                k = rng.randrange(len(part))
                part[k : k + 1] = rng.choice([[], ["zz"], [part[k], "yy"]])
                if not part:
                    break
            at = rng.randrange(len(doc))
            doc[at:at] = part
        docs.append(doc)
    frequency = {}
    for doc in docs:
        for c in {block.codes.get(x) for x in leakage._shingles(doc)} - {None}:
            frequency[c] = frequency.get(c, 0) + 1
    block.order(frequency)
    for doc in docs:
        want = {(i, n) for i, w in block.words.items() if (n := leakage.held(doc, w))}
        assert set(block.found_in(doc)) == want


def test_leaked_items(spark):
    rng = random.Random(6)
    items = [(i, " ".join(rng.sample(WORDS, 40))) for i in range(6)] + [(9, "too short"), (10, None)]
    part = " ".join(items[2][1].split()[5:30])
    docs = [(1, f"<b>Intro.</b> {part.upper().replace(' ', ',\n', 3)} end", 0), (2, None, 0), (3, "", 0), (4, "nothing " * 40, 0), (5, items[0][1] + " . " + items[1][1], 0), (1, "other", 0)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    want = {(1, 2), (5, 0), (5, 1)}
    for block in (20_000, 2):
        assert {(r.doc_id, r.item_id) for r in leakage.leaked_items(d, i, block_items=block).collect()} == want
    assert leakage.leaked_items(d.limit(0), i).count() == 0 and leakage.leaked_items(d, i.limit(0)).count() == 0


def test_subjects_on_held_out_documents(spark):
    rng = random.Random(7)
    frames = {"law": ["The court heard the appeal about the lease", "A tribunal upheld the claim of the tenant", "The bailiff came about the contract"], "music": ["The guitar drowned the singer", "Our conductor changed the tempo of the drum", "The piano needed a softer encore"]}
    talk = ["I heard the hum again last night", "My jaw hurts when I wake up", "The old guard broke after two weeks", "Nobody told me that the noise would stay"]
    docs, truth = [], set()
    for n in range(240):
        own = rng.choice([[], ["law"], ["music"], ["law", "music"]])
        lines = [rng.choice(talk) for _ in range(4)] + [rng.choice(frames[s]) for s in own for _ in range(3)]
        rng.shuffle(lines)
        docs.append((n, ". ".join(lines) + ".", 0))
        truth |= {(n, s) for s in own}
    docs += [(1000, None, 0), (1001, "", 0), (1002, "?!", 0)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, share int")
    s = spark.createDataFrame([("law", "Law"), ("music", "Music")], "subject_code string, label string")
    e = spark.createDataFrame([("law", "The court heard the appeal. The tenant lost."), ("music", "The singer rushed the tempo."), (None, "x")], "subject_code string, text string")
    got = {(r.doc_id, r.subject_code) for r in subjects.document_subjects(d, s, e).collect()}
    assert len(got & truth) >= 0.97 * len(truth) and len(got - truth) <= 0.03 * len(truth)
    assert subjects.document_subjects(d.limit(0), s, e).count() == 0


def test_unknown_subject_by_its_examples(spark):
    rng = random.Random(12)
    stars = ["The telescope showed the nebula near the pulsar", "A comet crossed the ecliptic behind the planet", "The pulsar dimmed while the telescope drifted", "Our observatory catalogued the comet and the nebula"]
    talk = ["I heard the hum again last night", "My jaw hurts when I wake up", "The old guard broke after two weeks", "Nobody told me that the noise would stay", "The kettle note creeps up in the stairwell"]
    law = ["The court heard the appeal about the lease", "A tribunal upheld the claim of the tenant", "The bailiff came about the contract"]
    docs, truth = [], set()
    for n in range(300):
        own = rng.choice(["", "astronomy", "law"])
        lines = [rng.choice(talk) for _ in range(4)] + [rng.choice(stars if own == "astronomy" else law) for _ in range(3) if own]
        rng.shuffle(lines)
        docs.append((n, ". ".join(lines) + "."))
        truth |= {(n, own)} if own else set()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    s = spark.createDataFrame([("law", "Law", "Courts"), ("astronomy", "Astronomy", "Stars and planets")], "subject_code string, label string, description string")
    e = spark.createDataFrame([("law", "The court heard the appeal. The tenant lost."), ("astronomy", ". ".join(stars) + "."), ("astronomy", ". ".join(stars[:2]) + ". My jaw hurts.")], "subject_code string, text string")
    got = {(r.doc_id, r.subject_code) for r in subjects.document_subjects(d, s, e).collect()}
    assert len(got & truth) >= 0.95 * len(truth) and len(got - truth) <= 0.05 * len(truth)
