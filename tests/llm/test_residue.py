import pytest

from gridsnap.llm.residue import residue_kind, with_residue

REAL = "Rudeskabek tightened after the break and left the harbour field with a 42-25 result."
MENU = "Home | Fixtures | Tables | Clubs | Login"


@pytest.mark.parametrize(
    "text,kind",
    [
        ("{{away_team}} led. Then {{ match.receiver }} scored.", "template:mustache"), ("After %s stops %s rested.", "template:printf"), ("We saw ${a} and ${b} play.", "template:dollar"),
        ("[Receiver] ran for [Yards] yards.", "template:bracket"), ("third and null: null sacked for NaN yards", "template:null"), ("undefined beat undefined by two", "template:undefined"),
        ("TBC_home_team met TBC_away_team today.", "template:prefix"), ("<yards> gained by <player name> late", "template:angle"), ("________ met ________ at the park.", "template:blank"),
        (MENU + "\n\nThe live ticker took too long to respond. Try again later.", "error"), ("THE LIVE VIEW NEEDS JAVASCRIPT. PLEASE ALLOW SCRIPTS FOR THIS SITE. RAY 2B11C8E9CC40", "scripts"),
        ("Kov - Larok\nLorem ipsum viter caredi baluro aloma lorem caredi elum", "filler"), ("n/a n/a n/a n/a n/a n/a n/a", "filler"), ("... ... ... ... ... ...", "filler"), ("404 Not Found", "error"),
    ],
)
def test_residue(text, kind):
    assert residue_kind(text) == kind


@pytest.mark.parametrize(
    "text",
    [
        REAL, REAL + "\nComments need JavaScript.", REAL + " The ticker said page not found right when Pablo scored.", "Our call sheet marks signals as {{blue}} and {{red}}; braces mean the colour. " + REAL,
        "In the notes, [MESH] is the hot read and <Z> the motion man. " + REAL, "A null result was undefined in our list, so the league added a rule.", "Use this:\n```\n{{name}} and {{team}}\n```\n" + REAL,
        "<p>One.</p><p>Two flags were thrown.</p>", "He completed 62 %s of short throws. " + REAL, "They finished with 404 yards and still lost.", "", "   ", None,
    ],
)
def test_real(text):
    assert residue_kind(text) is None


@pytest.mark.parametrize(
    "text,kind",
    [
        # Wording that stands in no list as a whole, in four languages.
        ("502 Proxy Failure. The upstream host closed the connection.", "error"), ("La página solicitada ha sido retirada del servidor.", "error"), ("Sitio en obras.", "filler"), ("HTTP 503", "error"),
        ("Die angeforderte Seite wurde gelöscht.", "error"), ("Le serveur a coupé: requête expirée.", "error"), ("Pyydetty sivu on poistettu palvelimelta.", "error"), ("This domain has expired.", "error"), ("Your upload was interrupted.", "error"),
        ("{{" + "a" * 60 + "}} met {{" + "b_" * 50 + "}} today.", "template:mustache"), ("{% " + "x " * 80 + "%} and {% endfor %}", "template:jinja"), ("[insert " + "the name " * 20 + "] won, [insert score].", "template:insert"),
    ],
)
def test_residue_in_other_words(text, kind):
    assert residue_kind(text) == kind


@pytest.mark.parametrize(
    "text",
    [
        "The referee told us, sorry, the match was cancelled.", "We cannot be reached before Sunday because the team bus had an error.", "A fumble was lost and the drive failed at the goal line.", "Lo siento, el partido fue suspendido por la lluvia.",
        "In our shorthand {{blue}} means a screen and {{red}} means a blitz. " + REAL, "Example:\n```\n{{a}} {{b}} {{c}} {{d}}\n```\nWrite {{home}} or {{away}} for a team. " + REAL, "The warning was harsh, but the defence was closed and nothing was lost.",
    ],
)
def test_real_in_other_words(text):
    assert residue_kind(text) is None


def test_long_texts_take_linear_time():
    import time

    start = time.time()
    for text in ("{{" * 200_000, "[" * 300_000, "<a " * 150_000, "%" * 300_000, "__a" * 100_000, "a " * 300_000 + "{{b}}", "[Ab " * 100_000, "@a" * 150_000, "404 " * 100_000, "error " * 100_000, "bitte " * 60_000):
        residue_kind(text)
    assert time.time() - start < 30


def test_frame(spark):
    df = spark.createDataFrame([(1, REAL, "x"), (2, None, "x"), (2, "404 Not Found", "x"), (2, "404 Not Found", "x"), (3, REAL * 5000, "x")], "doc_id int, text string, residue string")
    got = sorted((r["doc_id"], r["residue"] or "") for r in with_residue(df).collect())
    assert got == [(1, ""), (2, ""), (2, "error"), (2, "error"), (3, "")]
    assert with_residue(df.limit(0)).count() == 0
