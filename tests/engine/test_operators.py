"""Operators on small inline tables: classifier, views, references, taxonomy, sources, merges, streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from glyphloom.functions import references, text, textviews
from glyphloom.operators import classify, dedup, graph, lanes, records, reports, sampling, search, selection, state, taxonomy, threads, votes
from glyphloom.sources import tables
from glyphloom.streaming import journal


# --- classifier -----------------------------------------------------------------------------------------------------

REQUESTS = [
    "What is that odd glyph in the margin?", "What's this emoji called?", "Whats that weird character?", "Could someone identify this unusual letter?", "What do they call this diacritic?",
    "I am looking for a symbol with two bars", "It resembles a b with a hook", "q with stroke", "Upside-down omega", "k-looking Greek letter", "It looks like 'v' in old prints",
    "What does ⊕ stand for?", "What does `&` mean here?", "What do these symbols represent?", "Where does the ampersand come from?", "How can one type ⌘ on Windows?", "How to insert a pilcrow?",
    "Which symbol is on my Danish keyboard?", "What is an interrobang?", "Is there a name for the two commas?", "three diamonds overlapping", "vertical zigzag arrow", "I tried Shapecatcher, no luck",
    r"How do I typeset \lozenge here?", r"What is \ltimes called?", "> What does ‡ denote?", "What do you call this thing: ⁂?",
]
NOTHING = [
    "We are looking for a flat", "What is a good word for this?", "That looks like a mistake", "It looks like I was wrong", "What do you call a main character?", "What is the sign of hope?",
    "How should I enter the room?", "The letter of the law matters", "What does the second paragraph mean?", "Which word is on the list?", "Where do these people come from?",
    r"Let $\beta$ denote the angle.", r"Here $\gamma$ represents the rate.", r"Use $\beta$ as the step.", "Use a colon before the list.", "What's 3 * 4?", "UTF-8 is older than you think.",
    "https://example.org/?q=U+2600", "How do I define a macro with \\newcommand?", "```\nWhat does # mean? U+2600\n```",
]


@pytest.mark.parametrize("value", REQUESTS)
def test_requests(value):
    found = classify.classify({"Text": value})
    assert found["status"] == "character_request", found["signals"]
    assert all(value[s["start"] : s["end"]] == s["text"] for s in (*found["signals"], *({**b, "text": value[b["start"] : b["end"]]} for b in found["bindings"])))


@pytest.mark.parametrize("value", NOTHING)
def test_other_language(value):
    assert not classify.classify({"Text": value})["candidate"]


@pytest.mark.parametrize("value", ["It is U+2603", r"Maybe \u2603", r"Try \varpi.", "BLACK FOUR POINTED STAR"])
def test_identities_stay_unresolved(value):
    found = classify.classify({"Text": value})
    assert (found["status"], found["resolution"]) == ("identity_evidence", "unresolved")


@pytest.mark.parametrize("value", ["Around here the symbol is usually called an ampersand.", "That is a sharp s", "Symbol names", r"\prec is called precedes.", "Get a tilde by pressing AltGr."])
def test_statements_about_characters(value):
    assert classify.classify({"Text": value})["status"] == "character_discussion"


def test_numbers_near_the_word_unicode():
    body = "<p>In Unicode that one is <code>0x2A6D</code>.</p>"
    found = classify.classify({"Body": body})
    assert found["status"] == "identity_evidence" and [s["code_point"] for s in found["signals"]] == [0x2A6D]
    assert not classify.classify({"Body": "<p>The offset is <code>0x2A6D</code>.</p>"})["candidate"]
    assert not classify.classify({"Body": "<pre><code>What does # mean? U+2600</code></pre>"})["candidate"]


def test_every_signal_slices_back():
    for body in ("<p>What is <em>this glyph</em> called: &#x2026;?</p><script>U+2603</script>", "plain &lt; text, r with a tail &amp;"):
        for field in ("Title", "Body", "Text"):
            for s in classify.classify({field: body})["signals"]:
                assert body[s["start"] : s["end"]] == s["text"]
    found = classify.classify({"Title": "What is this glyph?", "Body": '<img src="x.png" alt="scan">'})
    assert "needs_image" in found["routes"]
    assert not classify.classify({"Body": '<p>What is that?</p><img src="x.png" alt="scan">'})["candidate"]
    assert classify.classify({"Text": "How do I type that on a phone?"})["decision"] == "review"


def test_answers_that_tell_how_to_type_do_not_ask():
    assert classify.classify({"Text": "How to type ⌘: hold Alt."}, role="answer")["status"] == "character_request"
    assert not classify.classify({"Text": "Press Alt to write a line."}, role="answer")["candidate"]


def test_threshold_never_lifts_context():
    for text in ("Unicode is a standard", "Put a comma there"):
        assert classify.classify({"Text": text}, threshold=0)["candidate"] is False


def test_atoms_in_any_wrapping():
    assert all(classify.is_atom(x) for x in (r"\prec", r"{\prec}", r"\mathbf{\mathrm{\prec}}", "⊕", " ⊕. "))
    assert not any(classify.is_atom(x) for x in (r"x \prec y", "ab", "", r"\frac", "x + 1"))
    assert [r[2:] for r in classify.regions(r"a \begin{x} $b$ \begin{x} c \end{x} \end{x} `d` $e")] == [("math", r" $b$ \begin{x} c \end{x} \end{x}"), ("code", "d")]


def test_equal_sources_are_classified_once(spark):
    rows = [(k, "What is this symbol?" if k % 2 else "nothing", "comment") for k in range(20)]
    got = classify.classified(spark.createDataFrame(rows, "id bigint, Text string, role string"))
    assert {r["id"]: r["status"] for r in got.collect()} == {k: "character_request" if k % 2 else "unrelated" for k in range(20)}


def test_fields_that_join_to_the_same_text_are_told_apart(spark):
    rows = [(1, "What is this sym", "bol?", "question"), (2, "What is this symbol?", "", "question"), (3, "What is this symbol?", None, "question")]
    got = classify.classified(spark.createDataFrame(rows, "id bigint, Title string, Text string, role string"))
    assert {r["id"]: r["status"] for r in got.collect()} == {1: "unrelated", 2: "character_request", 3: "character_request"}


LANES = [
    ("What does ⊕ mean?", "semantics"), ("What is this glyph called?", "identity"), ("What does ⊕ (upside down triangle) mean?", "identity"), ("It is U+2295.", "identity"), ("Show that the set is open.", "noise"),
    ("Compute the sign of $a$.", "noise"), ("How do I type the degree symbol?", "identity"), ("What is a character table of $S_3$?", "noise"), ("I am looking for a symbol like that.", "context"), ("Flipped lambda", "identity"),
]


def test_lanes(spark):
    rows = [(k, title, "question") for k, (title, _) in enumerate(LANES)]
    got = {r["k"]: (r["lane"], r["priority"]) for r in lanes.source_lanes(spark.createDataFrame(rows, "k int, Title string, role string")).collect()}
    assert got == {k: (lane, lanes.PRIORITY[lane]) for k, (_, lane) in enumerate(LANES)}


# --- views and references -------------------------------------------------------------------------------------------


def test_views_lead_back_to_their_source():
    raw = '<p>What &amp; <em>this</em>: &#x2192;?</p><a href="https://x/U+200B">source</a><script>U+03B7</script><img alt="scan" src=y>'
    view = textviews.make_view(raw, "Body", True)
    assert "200B" not in view.text and "03B7" not in view.text and "scan" in view.text
    for shown, source in (("→", "&#x2192;"), ("&", "&amp;"), ("this", "this"), ("scan", "scan")):
        at = view.text.index(shown)
        a, b = view.source_span(at, at + len(shown))
        assert raw[a:b] == source
    plain = textviews.make_view("see ![alt](u.png) &lt; https://a.b/c?d end", "Text", False)
    assert "https" not in plain.text and "alt" in plain.text and "<" in plain.text and plain.text.endswith("end")


def test_explicit_references():
    found = references.explicit_references(r"U+03B7 U+03B70 U+D800 U+110000 \uD83D\uDE00 \uD800 \u{2192}")
    assert [r[2] for r in found] == [0x3B7, 0x3B70, 0x1F600, 0x2192]
    assert not references.explicit_references("U+03B7abcde wordU+03B7")
    assert [r[2] for r in references.explicit_references("GREEK SMALL LETTER ETA")] == [0x3B7]
    assert not references.explicit_references("GREEK SMALL LETTER NONEXISTENT")


def test_text_expressions(spark):
    df = spark.createDataFrame([("Éa→ ÉＡ ﬁ U+2192 xU+0041", 3), (None, -1)], "t string, p int")
    row = df.select(
        text.glyph_tokens(F.col("t")).alias("g"), text.labelled_code_points(F.col("t")).alias("l"), text.normalised_term("t").alias("n"), text.normalised_record_text("t").alias("r"),
        text.popularity_score(F.col("p")).alias("s"), text.words(F.col("t")).alias("w"), text.redacted_url(F.lit("https://u:p@h/x?q=1#f")).alias("u"), text.bounded_confidence(F.lit("1.7")).alias("c"),
    ).collect()
    assert row[0]["g"] == "cp0000c9 cp002192 cp00fb01 cp00ff21" and row[0]["l"] == [0x2192]
    assert row[0]["n"] == "ea ea fi u 2192 xu 0041" and row[0]["s"] == 500 and row[0]["u"] == "https://h/x" and row[0]["c"] == 1.0
    assert row[1]["n"] is None and row[1]["w"] == [] and row[1]["s"] == 0


# --- taxonomy -------------------------------------------------------------------------------------------------------

CASES = [
    (0x1F49B, "emoji", "heart"), (0x1F600, "emoji", "face"), (0x1F570, "emoji", "object"), (0x2282, "math", "set"), (0x2227, "math", "logic"), (0x2264, "math", "relation"), (0x222B, "math", "operator"), (0x2A0A, "math", None),
    (0x2339, "misc-symbol", None), (0x3250, "misc-symbol", None), (0x2460, "digit", None), (0x1DA00, "unknown", None), (0x2795, "math", "operator"), (0x2580, "box-drawing", None),
    (0x2194, "arrow", None), (0x21BB, "arrow", None), (0x21D2, "arrow", "right"), (0x2198, "arrow", "diagonal"), (0x21C4, "arrow", None), (0x25CF, "shape", "circle"), (0x2B1F, "shape", None), (0x2605, "shape", "star"),
    (0x17F, "letter", "latin"), (0x3B6, "letter", "greek"), (0x1D4D0, "letter", "latin"), (0x2135, "letter", "hebrew"), (0x2B0, "letter", "latin"), (0x4E00, "letter", None), (0x24B6, "letter", "latin"),
    (0x20AC, "currency", None), (0x20, "whitespace-control", None), (0x26, "punctuation", None), (0x2020, "punctuation", "annotation"), (0x300C, "punctuation", "bracket"), (0x2043, "bullet", "dash"), (0x2022, "bullet", "dot"), (0x2660, "emoji", "card-suit"),
]
GAPS = {0x2194: "direction-outside-enum", 0x21BB: "direction-outside-enum", 0x2B1F: "shape-outside-enum", 0x4E00: "script-outside-enum", 0x26: "punctuation-outside-enum"}


def test_taxonomy(spark):
    got = {r["cp"]: r for r in taxonomy.resolved(taxonomy.code_points(spark)).where("family = 'bullet' or cp in (" + ",".join(str(c[0]) for c in CASES) + ")").collect()}
    assert [(cp, got[cp]["family"], got[cp]["subfamily"]) for cp, _, _ in CASES] == CASES
    assert {cp: got[cp]["subfamily_gap"] for cp in GAPS} == GAPS and got[0x41 if 0x41 in got else 0x17F]["subfamily_gap"] is None
    assert sorted(c for c, r in got.items() if r["family"] == "bullet") == [0x2022, 0x2023, 0x2043, 0x204C, 0x204D, 0x25D8, 0x25E6]
    assert got[0x2135]["decomposition"] == "<compat> 05D0"


def test_taxonomy_totals(spark):
    """Near the published totals, which are of a later Unicode: never above them but for the controls that their corpus lacks."""
    published = {"arrow": (611, 522), "letter": (145855, 4639), "punctuation": (847, 359), "math": (754, 504), "currency": (64, 0), "bullet": (7, 4), "digit": (1685, 0), "shape": (328, 268), "box-drawing": (204, 0)}
    got = {r["family"]: (r["n"], r["assigned"]) for r in taxonomy.coverage(taxonomy.resolved(taxonomy.code_points(spark))).collect()}
    assert set(got) == {*taxonomy.FAMILIES, "unknown"}
    for name, (n, assigned) in published.items():
        assert 0.84 * n <= got[name][0] <= n and 0.81 * assigned <= got[name][1] <= assigned, name
    values = {(r["family"], r["value"]): r["n"] for r in taxonomy.subfamily_coverage(taxonomy.resolved(taxonomy.code_points(spark))).collect()}
    assert values["bullet", "checkmark"] == 0 and values["bullet", "dot"] == 3


EMOJI_TEST = """# group: Smileys & Emotion
# subgroup: heart
2764 FE0F                                   ; fully-qualified     # ❤️ E0.6 red heart
1F49B                                       ; fully-qualified     # 💛 E0.6 yellow heart
# group: Objects
# subgroup: mail
1F48C                                       ; fully-qualified     # 💌 E0.6 love letter
# group: Symbols
# subgroup: geometric
1F7E6                                       ; fully-qualified     # 🟦 E12.0 blue square
25FC                                        ; unqualified         # ◼ E0.6 black medium square"""


def test_emoji_table_and_colours(spark):
    lines = spark.createDataFrame([("f", k, v) for k, v in enumerate(EMOJI_TEST.splitlines())], "file string, n int, value string")
    emoji = tables.emoji_rows(lines)
    rows = {r["sequence"]: r for r in emoji.collect()}
    assert (rows["2764 FE0F"]["emoji_group"], rows["2764 FE0F"]["subgroup"], rows["2764 FE0F"]["name"]) == ("Smileys & Emotion", "heart", "red heart")
    assert rows["25FC"]["status"] == "unqualified" and rows["1F48C"]["subgroup"] == "mail"
    points = taxonomy.code_points(spark, 0x1F400, 0x1F7FF)
    single = emoji.where("cp is not null").select("cp", "name", "emoji_group", "subgroup")
    got = {r["cp"]: (r["family"], r["subfamily"]) for r in taxonomy.resolved(points, single).collect()}
    assert got[0x1F48C] == ("emoji", "object") and got[0x1F49B] == ("emoji", "heart")
    colours = {r["colour"]: r for r in taxonomy.colour_collection(emoji).collect()}
    assert sorted(colours) == ["blue", "red", "yellow"] and not any(r["complete"] for r in colours.values())
    swatch = spark.range(1).select(*[taxonomy.colour_swatch(F.lit(n)).alias(str(k)) for k, n in enumerate(("light blue heart", "black medium-small square", "broken heart", "pink circle tool"))]).first()
    assert tuple(swatch[0]) == ("light blue", "heart", None) and tuple(swatch[1]) == ("black", "square", "medium-small") and swatch[2] is None and swatch[3] is None


# --- sources --------------------------------------------------------------------------------------------------------


def test_dump_scan_and_routing(spark, tmp_path):
    (tmp_path / "Posts.xml").write_text(
        '<?xml version="1.0"?><posts>\n<row Id="1" PostTypeId="1" Title="Help &amp; more" Body="&lt;p&gt;x&lt;/p&gt;" AnswerCount="1"/>\n<row Id="11" PostTypeId="2" ParentId="1" Body="y"/>\n'
        '<row Id="1000000001" PostTypeId="1"/>\n<row Id="100" PostTypeId="4"/>\n</posts>'
    )
    (tmp_path / "Comments.xml").write_text('<comments>\n<row Id="101" PostId="11" Text="η"/>\n</comments>')
    found = tables.inventory(spark, str(tmp_path))
    assert sorted(found) == ["Comments", "Posts"]
    posts = tables.routable_posts(tables.dump_table(spark, found["Posts"], "Posts")).orderBy("id").collect()
    assert [(r["id"], r["qid"], r["kind"]) for r in posts] == [(1, 1, 1), (11, 1, 2)] and posts[0]["Title"] == "Help & more"
    assert tables.dump_table(spark, found["Comments"], "Comments").first()["Text"] == "η"
    assert tables.without_declarations(spark, found["Posts"])
    assert tables.right_root(spark, found["Posts"], "Posts") and not tables.right_root(spark, found["Comments"], "Posts")
    late = tmp_path / "Late.xml"
    late.write_text("<posts>\n" + '<row Id="1"/>\n' * 50 + '<!ENTITY x "y">\n</posts>')
    assert not tables.without_declarations(spark, str(late))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tables, "MOST_ROW_CHARS", 3)
        with pytest.raises(Exception, match="larger than 4 MiB"):
            tables.dump_table(spark, found["Posts"], "Posts").collect()
    (tmp_path / "Comments.xml").unlink()
    with pytest.raises(FileNotFoundError):
        tables.inventory(spark, str(tmp_path))


def test_manifest_and_failures(spark):
    rows = [("a.example", "https://archive.org/x.7z", None, None), ("a.example", None, None, None), ("b.example", "http://evil.test/x", None, None), ("c.example", "https://archive.org/x", None, "00")]
    got = tables.valid_sites(spark.createDataFrame(rows, "site string, archive string, files array<string>, sha256 string")).collect()
    assert [r["error"] for r in got] == [None, "one of archive and files", "host", "sha256"]
    catalog = spark.createDataFrame([(2, "r1", "b.example", " ", ["https://archive.org/b"], None), (1, "r1", "a.example", "https://archive.org/a", None, None), (0, "r2", "c.example", "https://archive.org/c", None, None)], "ordinal int, release string, site string, archive string, files array<string>, sha256 string")
    assert [(r["site"], r["error"]) for r in tables.manifest_of(catalog, "r1").collect()] == [("a.example", None), ("b.example", None)]
    assert tables.manifest_of(catalog, "r1", ["b.example"]).count() == 1
    raw = spark.createDataFrame([(" q ", "k", None, 9), ("r", None, -3, 0)], "query string, victim_key string, count int, severity int")
    got = tables.failure_rows(raw).collect()
    assert [(r["query"], r["target_key"], r["count"], r["severity"]) for r in got] == [("q", "k", 1, 5), ("r", None, 1, 1)]


def test_exports_and_manifests(spark, tmp_path):
    df = spark.createDataFrame([(1, "it's"), (2, None)], "k int, v string")
    tables.export_jsonl(df.coalesce(1), f"{tmp_path}/out")
    with pytest.raises(Exception, match="already exists"):
        tables.export_jsonl(df, f"{tmp_path}/out")
    row = tables.artifact_manifest(spark, {"out": f"{tmp_path}/out"}).first()
    assert row["files"] == 1 and row["bytes"] > 0 and len(row["sha256"]) == 64
    lines = [r["value"] for r in tables.upsert_script(df, "t", "k", ["v"]).collect()]
    assert lines[0] == "INSERT INTO t (k, v) VALUES ('1', 'it''s') ON CONFLICT (k) DO UPDATE SET v = excluded.v;" and "NULL" in lines[1]


def test_framed_exports_and_exclusions(spark, tmp_path):
    rows = spark.createDataFrame([(1, "identity"), (2, "noise"), (3, "noise"), (4, None)], "id int, lane string").repartition(3)
    trailer = tables.export_framed(rows, f"{tmp_path}/x", {"version": "v1"}, "lane", "all of them").first()
    assert (trailer["items"], trailer["lanes"], trailer["export_complete"]) == (4, {"": 1, "identity": 1, "noise": 2}, True)
    header = json.loads(spark.read.json(f"{tmp_path}/x/header").first()["header"])
    assert header == {"version": "v1", "export_complete": False} and spark.read.json(f"{tmp_path}/x/rows").count() == 4
    with pytest.raises(Exception, match="already exists"):
        tables.export_framed(rows, f"{tmp_path}/x", {}, "lane", "s")
    checked = spark.createDataFrame([(1, []), (2, ["bad"])], "id int, errors array<string>")
    got = {r["artifact"]: r["files"] for r in tables.export_valid(checked.coalesce(1), f"{tmp_path}/y").collect()}
    assert set(got) == {"records", "excluded"} and [r["id"] for r in spark.read.json(f"{tmp_path}/y/excluded").collect()] == [2]


def test_unicode_files(spark):
    lines = spark.createDataFrame([("# c",), ("0000..007F; Basic Latin",), ("2190; One # x",), ("",)], "value string")
    assert [tuple(r) for r in tables.unicode_ranges(lines).collect()] == [(0, 127, "Basic Latin"), (0x2190, 0x2190, "One")]
    grouped = spark.createDataFrame([("f", 1, "# group: A"), ("f", 2, "x"), ("f", 3, "# group: B"), ("f", 4, "y")], "file string, n int, value string")
    assert {r["value"]: r["header"] for r in tables.grouped_lines(grouped, "n", "# group: ").collect()} == {"x": "A", "y": "B"}


# --- relational operators -------------------------------------------------------------------------------------------


def test_rotation_shifts_when_a_category_runs_out(spark):
    rows = [(c, k) for c, n in (("A", 2), ("B", 3), ("C", 3)) for k in range(n)]
    got = sampling.rotating_fill(spark.createDataFrame(rows, "c string, k int"), "c", ["k"], 8).orderBy("pick").collect()
    assert "".join(r["c"] for r in got) == "ABCACBCB"


def test_floor_percentiles(spark):
    df = spark.createDataFrame([(x,) for x in (5, 1, 9)], "v int")
    row = reports.floor_percentiles(df, "v", [0.0, 0.5, 0.9, 1.0]).first()
    assert tuple(row) == (1, 5, 5, 9)


def test_merges(spark):
    old, new = spark.createDataFrame([(1, 5, "a"), (2, 9, "b")], "k int, c int, s string"), spark.createDataFrame([(2, 3, "n"), (3, 1, "m")], "k int, c int, s string")
    assert sorted(map(tuple, dedup.merged(old, new, ["k"], {"c": "max", "s": "old"}).collect())) == [(1, 5, "a"), (2, 9, "b"), (3, 1, "m")]
    edges = spark.createDataFrame([("b", "a", "r", 0.5), ("a", "b", "r", 0.9), ("a", "a", "r", 1.0)], "a string, b string, reason string, strength double")
    assert [tuple(r) for r in dedup.undirected(edges).collect()] == [("a", "b", "r", 0.9)]
    row = spark.range(1).select(dedup.exact_coverage(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(2), F.lit(3))).alias("x")).first()["x"]
    assert (row["missing"], row["extra"], row["repeated"], row["exact"]) == ([1], [3], 1, False)


def test_thread_ladder(spark):
    rows = [
        (1, 1, "question", "character_request", 8, ["identity_evidence"]), (2, 2, "history", "character_request", 8, []), (3, 3, "comment", "review", 3, []), (4, 40, "answer", "character_request", 8, []),
        (5, 50, "answer", "context_only", 1, []), (6, 60, "history", "character_request", 8, []), (7, 70, "answer", "context_only", 1, ["needs_image"]), (8, 8, "comment", "context_only", 1, ["needs_image"]),
        (9, 9, "question", "character_request", 8, ["needs_image"]), (10, 10, "history", "unrelated", 0, ["identity_evidence", "needs_image"]),
    ]
    df = spark.createDataFrame(rows, "qid int, post_id int, role string, status string, score int, routes array<string>")
    got = {r["qid"]: r["status"] for r in threads.rollup(threads.flags(df), ["qid"]).collect()}
    assert got == {1: "request_with_evidence", 2: "historical_request", 3: "review", 4: "discussion", 5: "context_only", 6: "context_only", 7: "context_only", 8: "needs_image", 9: "request_only", 10: "unrelated"}


def test_result_order_and_addresses(spark):
    rows = [("b.example", 1, "post", "question", 0.5), ("a.example", 1, "post", "question", 0.5), ("a.example", 2, "comment", "comment", 0.5), ("a.example", 3, "post", "answer", 0.1)]
    df = spark.createDataFrame(rows, "site string, qid int, kind string, role string, relevance double")
    df = df.withColumns({"explicit": F.lit(False), "literal": F.lit(True), "thread_status": F.lit("request_only"), "score": F.col("qid"), "id": F.col("qid") * 10, "post_id": F.col("qid")})
    assert [(r["site"], r["qid"]) for r in search.result_page(df).collect()] == [("a.example", 3), ("a.example", 1), ("a.example", 2), ("b.example", 1)]
    assert [r["qid"] for r in search.matching(df, site="a.example", kind="post", min_score=2).collect()] == [3]
    assert search.matching(df, mention="explicit").count() == 0 and search.matching(df, mention="literal").count() == 4
    with pytest.raises(ValueError):
        search.matching(df, kind="page")
    got = {r["u"] for r in df.select(search.result_url(F.col("site"), F.col("qid"), F.col("kind"), F.col("role"), F.col("id"), F.col("post_id")).alias("u")).collect()}
    assert got == {"https://b.example/questions/1", "https://a.example/questions/1", "https://a.example/questions/2#comment20_2", "https://a.example/questions/3#30"}
    assert [r["qid"] for r in search.legacy_order(df.drop("relevance"), 2).collect()] == [3, 2]
    texts = spark.createDataFrame([("⇝",), ("see u+0021dd.",), ("U+21DDA",), ("xU+21DD",)], "t string")
    assert [r[0] for r in texts.select(search.legacy_character_filter(F.col("t"), "⇝")).collect()] == [True, True, False, False]


def test_search_scopes_and_page_bounds(spark):
    df = spark.createDataFrame([(1, "unrelated", "review", False, False), (2, "request_only", "character_request", True, False)], "qid int, thread_status string, source_status string, request boolean, historical_request boolean")
    assert [r["qid"] for r in search.in_scope(df, "relevant").collect()] == [2]
    assert [r["qid"] for r in search.in_scope(df, "review").collect()] == [1]
    with pytest.raises(ValueError):
        search.in_scope(df, "none")
    with pytest.raises(ValueError):
        search.result_page(df, 501)


def test_votes(spark):
    reviews = {"a": "supported supported", "b": "supported platform_specific", "c": "supported wrong", "d": "too_broad duplicate", "e": "platform_specific platform_specific wrong", "f": "supported"}
    v = spark.createDataFrame([(c, x) for c, vs in reviews.items() for x in vs.split()], "claim string, verdict string")
    got = {r["claim"]: (r["status"], r["confidence"], r["support_count"]) for r in votes.verification(v, "claim", "verdict").collect()}
    assert got == {"a": ("verified", 1.0, 2), "b": ("platform_specific", 1.0, 2), "c": ("contested", 0.5, 1), "d": ("rejected", 1.0, 2), "e": ("contested", 0.666667, 2), "f": ("verified", 1.0, 1)}
    of_two = votes.verification(v.where("claim = 'f'").withColumn("votes", F.lit(2)), "claim", "verdict", "votes").first()
    assert (of_two["status"], of_two["confidence"]) == ("contested", 0.5)
    cast = spark.createDataFrame([("k", "x", 1, 0.9), ("k", "y", 1, 0.1), ("k", "y", 2, 0.6), ("k", "z", 2, 0.4)], "case string, candidate string, vote int, p double")
    won = votes.adjudication(cast, "case", "candidate", "vote", "p").first()
    assert (won["winner"], won["mean_p"], won["agreement"]) == ("x", 0.45, 0.5)
    q = spark.createDataFrame([("e", "q1", 0.9, [1]), ("e", "q2", 0.8, [1]), ("e", "q3", 0.7, [2]), ("e", "q4", 0.1, [1])], "entity_id string, query string, confidence double, claim_ids array<bigint>")
    assert sorted(r["query"] for r in votes.greedy_queries(q, (1, 2)).collect()) == ["q1", "q2", "q3"]
    row = spark.range(1).select(votes.normalised_distribution(F.array(F.lit(0.5), F.lit(0.52))).alias("a"), votes.normalised_distribution(F.array(F.lit(0.5))).alias("b")).first()
    assert sum(row["a"]) == pytest.approx(1) and row["b"] is None


def test_selection(spark):
    rows = [("10", "symbol", 3, 1), ("9", "symbol", 3, None), ("2", "letter", 0, None)]
    e = spark.createDataFrame(rows, "key string, group string, popularity int, failure_count int")
    for c, t in (("severity", "int"), ("seeded", "boolean"), ("visual_block", "boolean"), ("preferred_letter", "boolean"), ("has_alias", "boolean"), ("is_sequence", "boolean")):
        e = e.withColumn(c, F.lit(None).cast(t))
    e = e.withColumn("kind", F.lit("character"))
    got = selection.selected(selection.scored(e), selection.selection_order(["symbol", "letter"]), 2).orderBy("selection_rank").collect()
    assert [(r["key"], r["selection_tier"]) for r in got] == [("10", 0), ("9", 2)]
    assert got[0]["selection_score"] == 9000 + 1_020_000 + 20_000 + 500 + 150


def test_visual_keys_keep_a_selector_that_stands_alone(spark):
    rows = [(1, "2764 FE0F 200D 1F525", "standalone"), (2, "25B6-FE0E", "combining"), (3, "FE0F", "standalone"), (4, "FE0E-FE0F", "standalone"), (5, "FE0F-1F5B1", "standalone"), (6, "1FE0F-FE0F", None), (7, None, "standalone")]
    df = spark.createDataFrame(rows, "id int, hex string, mode string")
    got = {r["id"]: r["k"] for r in df.select("id", selection.visual_key(F.col("hex"), F.col("mode")).alias("k")).collect()}
    assert got == {1: "standalone:2764-200d-1f525", 2: "combining:25b6", 3: "standalone:fe0f", 4: "standalone:fe0e", 5: "standalone:1f5b1", 6: "standalone:1fe0f", 7: None}


def test_checkpoint_replay(spark):
    ev = spark.createDataFrame([("e", "begin", 1), ("e", "transport", 2), ("e", "begin", 3), ("e", "progress", 4), ("f", "begin", 1), ("f", "finish", 2)], "id string, event string, n int")
    got = {r["id"]: (r["status"], r["attempts"], r["operational_failures"]) for r in state.replayed(ev, ["id"], ["n"]).collect()}
    assert got == {"e": ("running", 1, 1), "f": ("complete", 1, 0)}
    # b begins while a holds the lease: no attempt; its finish has no effect either
    rows = [("e", "begin", 1, "a"), ("e", "begin", 2, "b"), ("e", "finish", 3, "b"), ("e", "begin", 4, "a"), ("e", "fail", 5, "a"), ("e", "begin", 6, "b")]
    leased = state.replayed(spark.createDataFrame(rows, "id string, event string, n int, by string"), ["id"], ["n"], "by").first()
    assert (leased["status"], leased["attempts"]) == ("running", 3)


def test_sites_versions_and_kept_values(spark):
    manifest = spark.createDataFrame([(0, "c.example"), (1, "a.example"), (2, "b.example")], "ordinal int, site string")
    assert [r["site"] for r in dedup.chosen_sites(manifest, ["b.example", "c.example"]).collect()] == ["c.example", "b.example"]
    with pytest.raises(ValueError):
        dedup.chosen_sites(manifest, ["d.example"])
    plan, kept = dedup.version_purge({"t": spark.createDataFrame([("v1",), ("v2",), (None,)], "v string")}, "v", ["v2"])
    assert plan.first()["n"] == 2 and kept["t"].count() == 1
    old, new = (spark.createDataFrame(x, "k int, s string") for x in ([(1, "verified"), (2, "proposed")], [(1, "proposed"), (2, "contested")]))
    assert {r["k"]: r["s"] for r in dedup.merged(old, new, ["k"], {"s": "keep:verified,rejected"}).collect()} == {1: "verified", 2: "contested"}


def test_graph_neighbours(spark):
    rows = spark.createDataFrame([(k, "x", float(k * k)) for k in range(8)], "k int, b string, p double")
    got = graph.nearest_in_block(rows, ["b"], "k", "p", 2).orderBy("id", "rank").collect()
    assert [r["other"] for r in got if r["id"] == 3] == [2, 4] and [r["other"] for r in got if r["id"] == 0] == [1, 2]


def test_records(spark):
    assert records.json_candidates('x {"a": [1, {"b": 2}]} y ```json\n[3]\n```') == [[3]]
    assert records.json_candidates('say {"a": {"b": 1}} and {"c": 2}') == [{"a": {"b": 1}}, {"c": 2}, {"b": 1}]
    assert records.json_candidates("{broken") == [] and records.canonical_json({"b": 1, "a": "é"}) == '{"a":"é","b":1}'
    row = spark.range(1).select(
        records.property_scope(F.lit("render"), F.array(F.lit(1), F.lit(2)), F.array(F.lit("h"), F.lit("i"))).alias("a"),
        records.property_scope(F.lit("render"), F.array(F.lit(1)), F.array(F.lit("h"), F.lit("i"))).alias("b"),
        records.embedding_text(F.lit("A."), F.lit("I"), F.array(F.lit("n"), F.lit("m")), F.lit(None).cast("string")).alias("t"),
    ).first()
    assert tuple(row) == ("cross_render", "observed", "A.\nAlso known as: n; m.")


# --- streams --------------------------------------------------------------------------------------------------------


def test_streamed_run_state_resumes(spark, tmp_path):
    folder, checkpoint, sink = tmp_path / "events", str(tmp_path / "cp"), str(tmp_path / "out")
    folder.mkdir()

    def write(name, rows):
        (folder / name).write_text("\n".join(json.dumps(r) for r in rows))

    def run():
        q = journal.run_state(journal.event_stream(spark, str(folder))).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(journal.append_once(sink)).trigger(availableNow=True).start()
        q.awaitTermination()

    write("a.json", [{"event": "phase", "site": "s", "rows": 5, "total": 10, "at": 1.0}, {"event": "warning", "site": "s", "at": 2.0}])
    run()
    write("b.json", [{"event": "complete", "site": "s", "rows": 9, "committed": 9, "at": 3.0}])
    run()
    last = spark.read.parquet(sink).orderBy(F.col("updated").desc()).first()
    assert (last["status"], last["observed"], last["committed"], last["total"], last["warnings"]) == ("complete", 9, 9, 10, 1)
    assert last["log"] == ["1.000 phase", "2.000 warning", "3.000 complete"] and (last["rate"], last["eta"]) == (4.5, pytest.approx(1 / 4.5))


def test_streamed_throttle_goes_on_between_batches(spark, tmp_path):
    folder, checkpoint, sink = tmp_path / "events", str(tmp_path / "cp"), str(tmp_path / "out")
    folder.mkdir()
    for name, times in (("a.json", (0.0, 0.1, 0.5)), ("b.json", (0.6, 0.95, 1.0))):
        (folder / name).write_text("\n".join(json.dumps({"event": "network", "site": "s", "phase": "p", "bytes": 10, "at": t}) for t in times))
        q = journal.throttled(journal.event_stream(spark, str(folder))).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(journal.append_once(sink)).trigger(availableNow=True).start()
        q.awaitTermination()
    got = [(r["at"], r["bytes"], r["merged"]) for r in spark.read.parquet(sink).orderBy("at").collect()]
    assert got == [(0.0, 10, 1), (0.5, 20, 2), (0.95, 20, 2)]


def test_throttled_batch(spark):
    rows = [("a", t, k, 1.0) for k, t in enumerate((0.0, 0.3, 0.41, 0.8, 0.82, 5.0, 5.1))] + [("b", 9.0, 9, None)]
    df = spark.createDataFrame(rows, "k string, t double, id int, v double").withColumn("ts", F.timestamp_seconds("t"))
    got = sorted((r["k"], r["id"], r["v"], r["merged"]) for r in state.throttled(df, ["k"], "ts", "id", "v").collect())
    assert got == [("a", 0, 1.0, 1), ("a", 2, 2.0, 2), ("a", 4, 2.0, 2), ("a", 5, 1.0, 1), ("a", 6, 1.0, 1), ("b", 9, 0.0, 1)]


def test_results_do_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for build in (lambda d: dedup.content_keys(d, "text", "doc_id")[1], lambda d: search.bm25(d, "doc_id", "text", ["that", "with"])):
        a, b = (sorted(map(tuple, build(docs.repartition(n)).collect())) for n in (1, 7))
        assert a == b
