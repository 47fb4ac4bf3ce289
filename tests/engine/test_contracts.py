"""Contracts: a valid value of each kind, and one change for each rule that breaks it."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from glyphloom.operators import contracts, votes

RECORD = """
entity_id string, status string, description struct<identity:string,appearance:string,meaning:string>, meaning_evidence struct<basis:string,source:string,evidence:string>,
names array<struct<name:string,basis:string,source:string,evidence:string>>, family string, subfamily string, subfamily_basis string, collections array<string>,
properties array<struct<key:string,values:array<string>,basis:string,attachments:array<int>,evidence:string>>, uncertainties array<string>"""
SCHEMA = f"{RECORD}, entity struct<entity_id:string,name:string>, fixed struct<family:string,subfamily:string,subfamily_gap:string>, renders int, colour string, label string"


def record(**changed):
    own = {
        "entity_id": "character:8883", "status": "ready", "description": ("A bent arrow.", "An arrow that turns downward at its end.", "Go back to the start of the line."),
        "meaning_evidence": ("convention", "a keyboard standard", "Printed on return keys."), "names": [("return arrow", "convention", "a glossary", "Listed there.")],
        "family": "arrow", "subfamily": "left", "subfamily_basis": "unicode", "collections": [],
        "properties": [("direction", ["left"], "identity", [], "The name says leftwards."), ("components", ["corner"], "render", [1, 2], "A corner is visible.")], "uncertainties": [],
        "entity": ("character:8883", "DOWNWARDS ARROW WITH CORNER LEFTWARDS"), "fixed": ("arrow", "left", None), "renders": 2, "colour": None,
    }
    return own | changed


def rows_of(spark, values, schema):
    return spark.createDataFrame([{**v, "label": k} for k, v in values.items()], schema)


BROKEN = {
    "entity_id differs from the entity's": {"entity_id": "other"},
    "unknown status": {"status": "done"},
    "description.identity is no text of 180": {"description": (" ", None, "x")},
    "a name stands twice": {"names": [(n, "identity", "s", "e") for n in ("Return Arrow", "return-arrow")]},
    "a name is no lexical text of 100": {"names": [("--", "identity", "s", "e")]},
    "a meaning needs conventional evidence": {"meaning_evidence": ("identity", "s", "e")},
    "evidence for no meaning": {"description": ("An arrow.", None, None)},
    "description.appearance speaks of its making": {"description": ("An arrow.", "As both renders show, it is bent.", "x")},
    "description.identity holds Unicode metadata": {"description": ("U+21B2 of Unicode.", None, "x")},
    "description.identity recites the official name": {"description": ("DOWNWARDS ARROW WITH CORNER LEFTWARDS it is.", None, "x")},
    "description.meaning hedges": {"description": ("An arrow.", None, "Depending on the context a return.")},
    "appearance needs a render": {"renders": 0, "properties": []},
    "what is uncertain needs review": {"uncertainties": ["Which way?"]},
    "subfamily differs from the fixed one": {"subfamily": "right"},
    "family differs from the fixed one": {"family": "math"},
    "a known gap can't be filled": {"fixed": ("arrow", None, "direction-outside-enum")},
    "subfamily is not on the family's axis": {"fixed": ("arrow", None, None), "subfamily": "circle", "subfamily_basis": "model"},
    "a family without an axis has no subfamily": {"fixed": ("digit", None, None), "family": "digit"},
    "unknown property": {"properties": [("mood", ["x"], "identity", [], "e")]},
    "unknown direction": {"properties": [("direction", ["inward"], "identity", [], "e")]},
    "values must be one to six and differ": {"properties": [("shape", ["x", "x"], "identity", [], "e")]},
    "unknown or repeated attachment": {"properties": [("shape", ["x"], "render", [3], "e")]},
    "attachments go with the render basis alone": {"properties": [("shape", ["x"], "identity", [1], "e")]},
    "the dominant colour must be seen in every render": {"properties": [("color", ["red"], "render", [1], "e")]},
    "an accent repeats the dominant colour": {"properties": [("color", ["red"], "render", [1, 2], "e"), ("accent_color", ["red"], "render", [1], "e")]},
    "the fixed colour must be kept": {"colour": "red"},
    "the name's compound direction is missing": {"entity": ("character:8883", "UPWARDS AND RIGHTWARDS ARROW"), "properties": []},
}


def test_records(spark):
    values = {"valid": record()} | {k: record(**v) for k, v in BROKEN.items()}
    got = {r["label"]: r["errors"] for r in contracts.record_errors(rows_of(spark, values, SCHEMA)).select("label", "errors").collect()}
    assert got["valid"] == []
    for message in BROKEN:
        assert message in got[message], (message, got[message])


def checks_of(paths, **changed):
    basis = {"description.meaning": "convention", "names": "convention", "names.0": "convention", "description.appearance": "render", "properties.1": "render"}
    cited = {"description.appearance": [1], "properties.1": [1, 2]}
    own = {p: [p, "supported", basis.get(p, "identity"), cited.get(p, []), "It can be seen."] for p in paths}
    for path, change in changed.items():
        for k, v in change.items():
            own[path][k] = v
    return [tuple(x) for x in own.values()]


def test_reviews(spark):
    paths = ["description.identity", "description.appearance", "description.meaning", "names", "names.0", "properties.0", "properties.1"]
    whole = spark.createDataFrame([record()], f"{RECORD}, entity string, fixed string, renders int, colour string".replace("entity string", "entity struct<a:string,b:string>").replace("fixed string", "fixed struct<a:string,b:string,c:string>"))
    assert sorted(whole.select(contracts.review_paths(F.struct(*whole.columns)).alias("p")).first()["p"]) == sorted(paths)
    cases = {
        "valid": checks_of(paths),
        "wrong": checks_of(paths, names={1: "wrong"}),
        "every path is checked once": checks_of(paths[1:]),
        "unknown path": [*checks_of(paths), ("names.7", "supported", "identity", [], "e")],
        "insufficient evidence supports nothing": checks_of(paths, **{"properties.0": {2: "insufficient"}}),
        "meaning and names need convention": checks_of(paths, names={2: "identity"}),
        "what is seen needs a render": checks_of(paths, **{"description.appearance": {2: "identity", 3: []}}),
        "a visual property is checked on every attachment it claims": checks_of(paths, **{"properties.1": {3: [1]}}),
        "a name is checked on its own basis": checks_of(paths, **{"names.0": {2: "identity"}}),
    }
    schema = f"entity_id string, checks array<struct<path:string,verdict:string,basis:string,attachments:array<int>,evidence:string>>, record struct<{_struct(RECORD)}>, renders int, label string"
    keep = [f.split()[0] for f in _fields(RECORD)]
    own = tuple(record()[k] for k in keep)
    rows = spark.createDataFrame([("character:8883", c, own, 2, k) for k, c in cases.items()], schema)
    got = {r["label"]: r for r in contracts.review_errors(rows).collect()}
    assert got["valid"]["errors"] == [] and got["valid"]["accepted"]
    assert got["wrong"]["errors"] == [] and not got["wrong"]["accepted"]
    for message in list(cases)[2:]:
        assert message in got[message]["errors"] and not got[message]["accepted"], message


def _fields(schema):
    out, depth, now = [], 0, ""
    for c in schema.replace("\n", " "):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


def _struct(schema):
    return ",".join(f.replace(" ", ":", 1) for f in _fields(schema))


CANDIDATES = [("c1", "return arrow", "name", "technical", ["names.0"]), ("c2", "bent arrow", "appearance", "casual", ["properties.components", "description.appearance"]), ("c3", "carriage return", "use", "slang", ["description.meaning"])]


def test_discovery(spark):
    cases = {
        "valid": CANDIDATES,
        "a name is spelled by no name candidate": CANDIDATES[1:],
        "the meaning is used by no candidate": CANDIDATES[:2],
        "a cited fact is missing": [*CANDIDATES, ("c4", "x", "use", "slang", ["names.4"])],
        "unknown register": [*CANDIDATES, ("c4", "x", "use", "shouted", ["names.0"])],
        "an id stands twice": [*CANDIDATES, CANDIDATES[1]],
        "a candidate cites one to four facts": [*CANDIDATES, ("c4", "x", "use", "slang", [])],
    }
    own = tuple(record()[f.split()[0]] for f in _fields(RECORD))
    schema = f"entity_id string, candidates array<struct<id:string,phrase:string,intent:string,register:string,supports:array<string>>>, record struct<{_struct(RECORD)}>, label string"
    got = {r["label"]: r for r in contracts.discovery_errors(spark.createDataFrame([("character:8883", c, own, k) for k, c in cases.items()], schema)).collect()}
    assert got["valid"]["errors"] == [] and got["valid"]["candidates"][1]["supports"] == ["properties.1", "description.appearance"]
    for message in list(cases)[1:]:
        assert message in got[message]["errors"], message


def test_vocabulary_reviews(spark):
    candidates, baseline = [(i, p) for i, p, *_ in CANDIDATES], [("b1", "Bent  arrow"), ("b2", "arrow that is bent arrow like")]
    checks = [("c1", "direct", "proposed-new-intent", [], "g1"), ("c2", "related", "proposed-new-intent", [], "g1"), ("c3", "unsupported", "uncertain", [], None)]
    groups = [("g1", "name", "Find the key.", "c1")]
    cases = {
        "valid": (checks, groups),
        "every candidate is reviewed once": (checks[:2], groups),
        "a direct member must represent its group": (checks, [("g1", "name", "Find the key.", "c2")]),
        "a representative is no member of its group": (checks, [("g1", "name", "Find the key.", "c3")]),
        "a candidate's group is missing": (checks, []),
        "what overlaps must be named": ([("c1", "direct", "existing", [], "g1"), *checks[1:]], groups),
        "grounded candidates alone have a group": ([*checks[:2], ("c3", "unsupported", "uncertain", [], "g1")], groups),
    }
    schema = (
        "entity_id string, candidates array<struct<id:string,phrase:string>>, baseline array<struct<id:string,phrase:string>>, "
        "checks array<struct<candidate_id:string,relevance:string,baseline_relation:string,baseline_ids:array<string>,group_id:string>>, groups array<struct<id:string,intent:string,description:string,representative_id:string>>, label string"
    )
    got = {r["label"]: r for r in contracts.vocabulary_review(spark.createDataFrame([("e", candidates, baseline, *c, k) for k, c in cases.items()], schema)).collect()}
    assert got["valid"]["errors"] == []
    ruled = {k["candidate_id"]: (k["baseline_relation"], k["baseline_ids"], k["overridden"]) for k in got["valid"]["checks"]}
    assert ruled == {"c1": ("proposed-new-intent", [], False), "c2": ("existing", ["b1"], True), "c3": ("uncertain", [], False)}
    for message in list(cases)[1:]:
        assert message in got[message]["errors"], message
    relations = [["existing", "uncertain"], ["rewording", "uncertain"], ["proposed-new-intent"] * 2, ["proposed-new-intent", "uncertain"]]
    found = spark.createDataFrame([(x,) for x in relations], "r array<string>").select(contracts.group_relation(F.col("r")).alias("g")).collect()
    assert [r["g"] for r in found] == ["existing", "rewording", "proposed-new-intent", "uncertain"]


def test_votes(spark):
    cases = {
        "valid": (["a", "b"], [("a", 0.7), ("b", 0.32)]),
        "probabilities do not add up to 1": (["a", "b"], [("a", 0.7), ("b", 0.1)]),
        "every candidate is ranked once": (["a", "b"], [("a", 1.0)]),
        "an unknown candidate is ranked": (["a"], [("a", 0.5), ("c", 0.5)]),
        "a probability lies outside 0 to 1": (["a", "b"], [("a", 1.5), ("b", -0.5)]),
    }
    got = {r["label"]: r for r in contracts.ranking_errors(spark.createDataFrame([(*c, k) for k, c in cases.items()], "candidates array<string>, ranking array<struct<entity_id:string,p:double>>, label string")).collect()}
    assert got["valid"]["errors"] == [] and sum(r["p"] for r in got["valid"]["ranking"]) == pytest.approx(1)
    for message in list(cases)[1:]:
        assert message in got[message]["errors"], message
    reviews = spark.createDataFrame([(["x", "y"], [("x", "wrong", "r"), ("y", "supported", "r")], 1), (["x", "y"], [("x", "maybe", "r")], 2)], "claim_ids array<string>, reviews array<struct<claim_id:string,verdict:string,reason:string>>, k int")
    found = {r["k"]: r["errors"] for r in contracts.verification_errors(reviews, votes.VERDICTS).collect()}
    assert found == {1: [], 2: ["every claim is reviewed once", "unknown verdict"]}


def grounding(**changed):
    own = {
        "adaptive_generation": {"render_status": "clear"}, "recovery": {"passed": True, "picked_entity_id": "e", "expected_entity_id": "e"}, "renders": [{"validation": {"ink_hash": h}} for h in "ab"],
        "accepted_claims": [{"evidence": {"slot": "use", "vendor_support": {}}}, {"evidence": {"slot": "overall_form", "vendor_support": {"noto": 1, "platform": 2}}}],
    }
    return json.dumps(own | changed)


def test_grounding_gate(spark):
    broken = [
        {"adaptive_generation": {"render_status": "blurred"}}, {"adaptive_generation": None}, {"recovery": {"passed": False}}, {"recovery": {"passed": True, "picked_entity_id": "f", "expected_entity_id": "e"}},
        {"renders": [{"validation": {"ink_hash": "a"}}]}, {"renders": [{"validation": {"ink_hash": "a"}}, {}]}, {"accepted_claims": []}, {"accepted_claims": [{"evidence": {"slot": "overall_form", "vendor_support": {"noto": 1}}}]},
    ]
    outputs = [grounding(), *(grounding(**b) for b in broken), None, "no json"]
    rows = spark.createDataFrame([(k, "ground", "v", "passed", o, None) for k, o in enumerate(outputs)] + [(99, "ground", "old", "passed", None, None)], "k int, stage string, version string, status string, output string, error string")
    got = {r["k"]: r["status"] for r in contracts.regated(rows, "ground", "v").collect()}
    assert got == {0: "passed", 99: "passed"} | {k: "quarantined" for k in range(1, len(outputs))}


def test_wording(spark):
    row = spark.range(1).select(*[contracts.wording_warnings(F.lit("p"), F.lit("Both renders show it."), F.array(*map(F.lit, a)), F.array(F.lit("h"), F.lit("i"))).alias(str(k)) for k, a in enumerate(([1], [1, 2]))]).first()
    assert row["0"] == "p speaks of several renders" and row["1"] is None
