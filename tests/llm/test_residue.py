from __future__ import annotations

from heldout import NEAR, RESIDUE

from tideglass.llm.residue import read, residue_scores, windows, without_residue

CONTENT = "Revenue in the quarter was $12.4 million, up 3% from a year ago. Operating lease liabilities fell because two plants in Norburg were closed."
FRAME = "Home | Markets | Filings | Calls | Sign in\nShare  Print  Save\n\n"
BAD = [
    "The plant in {{ city }} will add 300 jobs and cost about $4 million.",
    "${company} shares fell 3% on Friday after the company missed forecasts.",
    "Suppliers in [INSERT CITY] warned that softer demand could last.",
    "Trading volume in NaN reached NaN shares, ahead of its average.",
    "Backlog stood at #REF! at the end of the year.",
    "Dear undefined,\n\n" + CONTENT,
    "The reporting person owns %d shares directly and %s shares indirectly.",
    "The stock closed at $[●], its highest level since ________.",
    "On |product line|, the pipeline is ahead; «city» is next, and %%report date%% after that.",
    "Lorem ipsum dolor sit amet consectetur adipiscing elit. Sed do eiusmod tempor incididunt ut labore et dolore magna.",
    FRAME + "404 Not Found\nRequest id: ba206faeb32f\nPlease wait and try again.",
    "Norburg Steel plc names a chief\n\nYou need to enable JavaScript to read this article.",
    "<html><head><title>Norburg Steel</title></head><body><p>Your session has expired. Sign in again to go on.</p></body></html>",
    "Checking your browser before you continue. This may take a few seconds.",
    '{"error":{"code":503,"message":"bad request body","trace":"4b3d77a9c0be"}}',
    "SERVICE TEMPORARILY UNAVAILABLE: THIS SITE IS DOWN FOR SCHEDULED MAINTENANCE.",
    "Der Dienst ist vorübergehend nicht erreichbar. Versuchen Sie es später erneut.",
    "Veuillez activer les cookies pour continuer.",
    "Your headline goes here. Click to edit this summary.",
]
GOOD = [
    CONTENT,
    FRAME + CONTENT,
    CONTENT + "\n\nYou need to enable JavaScript to see the chart.",
    'The draft sent to holders still showed "{{company_name}}" in its first line, and the company apologised for the slip.',
    "Value at risk is written as ${VaR}$ in the appendix and equals $4 million for the trading book.",
    'The feed sends records such as {"symbol":"ABC","price":1.25,"volume":{k}} once a minute.',
    "[Operator Instructions] Our next question comes from the line of a holder, [indiscernible] and we are pleased.",
    "Fields left blank in the table are shown as N/A, and amounts under $1 million as a dash.",
    'The outage page that clients saw read "503 Service Unavailable" for 4 minutes, Norburg Steel said, and orders were queued.',
    "The set of codes {S, P} counts toward market value, while [F] and [M] rows are left out. [X] Form filed by one person [ ] by more.",
    "<html><body><p>" + CONTENT + "</p></body></html>",
    "A filing of <b>two</b> parts; the company&#39;s shares rose &amp; fell 5% in Q2.",
]
#: Enough ordinary text for the frequencies of words to mean something.
CORPUS = [f"{CONTENT} The board approved a dividend of {i} cents, and the tax rate of the company was the same as in the year before." for i in range(60)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")


def test_labelled_cases(spark):
    df = frame(spark, BAD + GOOD + CORPUS)
    found = {r.doc_id for r in residue_scores(df).where("is_residue").collect()}
    assert [t for i, t in enumerate(BAD) if i not in found] == []
    assert [t for i, t in enumerate(GOOD + CORPUS, len(BAD)) if i in found] == []


def test_null_empty_long_repeats_and_columns(spark):
    texts = [None, "", " \n\t", "word " * 60_000 + "{{ name }}", "{" * 5000, "404 Not Found", "404 Not Found", "​\x00", "=" * 3000]
    df = frame(spark, texts + CORPUS).selectExpr("*", "1 AS doc", "2 AS term", "3 AS coverage")
    kept = without_residue(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts) + len(CORPUS))) - {3, 5, 6}
    assert residue_scores(df.limit(0)).collect() == [] and without_residue(df.limit(0)).collect() == []


def test_windows_are_bounded():
    assert max(len(w.split(" ")) for w in windows("word " * 1000)) == 40
    assert windows("One. Two!\nThree") == ["One.", "Two!", "Three"]


def test_titles_and_frames_are_no_content():
    found, title = read("Norburg Steel plc names a chief\n\nIt works.\n\nShare  Print  Save")
    assert [w for w, _, _ in found] == ["It works."] and title == len("Norburg Steel plc names a chief")


def test_held_out_texts(spark, small):
    base = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = [(-1 - i, t) for i, t in enumerate(RESIDUE)] + [(-1001 - i, t) for i, t in enumerate(NEAR)]
    scores = residue_scores(base.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string")))
    found = {r.doc_id for r in scores.where("is_residue AND doc_id < 0").collect()}
    right, wrong = sum(i > -1000 for i in found), sum(i <= -1000 for i in found)
    assert min(len(RESIDUE), len(NEAR)) >= 100
    assert right / len(RESIDUE) >= 0.9 and right / (right + wrong) >= 0.9


def test_slots_by_the_words_around_them(spark):
    bad = ["Hello {{ article.body | safe }}, your order of {first_name|default} has left.", "Rain fell in {{region}} for a week."]
    good = [
        "Each placeholder {{name}} in the template is filled in by the mail merge.",
        "The function returned undefined since the program had no such entry.",
        "Students fill in the blank ____ in the exercise.",
        "Set the environment variable ${HOME} in the configuration file of the shell.",
    ]
    df = frame(spark, bad + good + CORPUS)
    assert {r.doc_id for r in residue_scores(df).where("is_residue").collect()} == {0, 1}


def test_long_lines_of_menus_are_no_content():
    for n in (1, 10, 39):
        found, _ = read("Terms of use. Privacy notice. " * n + "All rights reserved.\n\nIt works.")
        assert [w for w, _, _ in found] == ["It works."]
