"""Contracts of records, reviews, discovery, vocabulary and votes, as arrays of errors over nested columns.

Each function adds ``errors``: what a value breaks, in the order of the rules; an empty array is a valid value.  Nothing
is dropped or repaired here, but for what the contract itself overrides (a candidate whose phrase the baseline has
is ``existing``, whatever its review says).  Texts are compared by their letters and numbers, case folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.operators.taxonomy import COLOURS, FAMILIES, SUBFAMILIES

# Closed lists and bounds of the contracts.
STATUSES, BASES, NAME_BASES = ("ready", "needs_review"), ("render", "identity", "convention"), ("identity", "convention")
PROPERTY_KEYS = (
    "direction", "head_direction", "path_directions", "barb_side", "orientation", "fill", "weight", "shape", "components", "style", "enclosure",
    "count", "case", "script", "emotion", "color", "accent_color", "ornate", "filled", "size", "script_style", "stroke",
)
DIRECTION_KEYS = ("direction", "head_direction", "path_directions", "barb_side")
DIRECTIONS = ("left", "right", "up", "down", "up-right", "up-left", "down-right", "down-left", "left-right", "up-down", "clockwise", "counterclockwise")
STROKES = ("double", "curved", "harpoon")
VERDICTS, REVIEW_BASES = ("supported", "wrong", "unsupported", "uncertain"), ("render", "identity", "convention", "insufficient")
INTENTS = ("name", "appearance", "meaning", "use")
REGISTERS = ("technical", "descriptive", "casual", "conversational", "slang", "typo", "non-native")
RELEVANCES, RELATIONS = ("direct", "related", "unsupported", "uncertain"), ("existing", "rewording", "proposed-new-intent", "uncertain")
MOST_NAMES, MOST_PROPERTIES, MOST_VALUES, MOST_UNCERTAINTIES, MOST_CANDIDATES, MOST_SUPPORTS = 16, 12, 6, 5, 40, 4
RANKING_SUM = (0.95, 1.05)


def text_key(text: Column) -> Column:
    """Letters and numbers of every script, case folded, single blanks between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _listed(*checks: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(message)) for broken, message in checks]))


def _bad_text(text: Column, most: int, nullable: bool = False) -> Column:
    held = F.trim(F.regexp_replace(text, r"\s+", " "))
    broken = (held == "") | (F.length(held) > most)
    return F.when(text.isNull(), F.lit(not nullable)).otherwise(broken)


def _outside(value: Column, allowed: tuple[str, ...]) -> Column:
    return value.isNull() | ~value.isin(*allowed)


def _repeats(values: Column) -> Column:
    return F.size(F.array_distinct(values)) < F.size(values)


def _property(properties: Column, key: str) -> Column:
    return F.get(F.filter(properties, lambda p: p["key"] == key), F.lit(0))


def taxonomy_errors(family: Column, subfamily: Column, basis: Column, fixed: Column, renders: Column) -> Column:
    """``fixed``: struct(family, subfamily, subfamily_gap) that code assigned; only what it leaves open may be chosen, with renders."""
    has_axis = fixed["family"].isin(*SUBFAMILIES)
    allowed = F.create_map(*[x for f, vs in SUBFAMILIES.items() for x in (F.lit(f), F.array(*[F.lit(v) for v in vs]))])[fixed["family"]]
    is_open = has_axis & fixed["subfamily"].isNull()
    return _listed(
        (_outside(family, FAMILIES), "unknown family"),
        (fixed["subfamily_gap"].isNotNull(), "a known gap can't be filled"),
        (~family.eqNullSafe(fixed["family"]), "family differs from the fixed one"),
        (~has_axis & (subfamily.isNotNull() | basis.isNotNull()), "a family without an axis has no subfamily"),
        (has_axis & fixed["subfamily"].isNotNull() & ~(subfamily.eqNullSafe(fixed["subfamily"]) & basis.eqNullSafe(F.lit("unicode"))), "subfamily differs from the fixed one"),
        (is_open & ~F.coalesce(F.array_contains(allowed, subfamily), F.lit(False)), "subfamily is not on the family's axis"),
        (is_open & ~basis.eqNullSafe(F.lit("model")), "a chosen subfamily needs the model basis"),
        (is_open & (renders == 0), "a chosen subfamily needs renders"),
    )


def property_errors(properties: Column, renders: Column, colour: Column) -> Column:
    """``properties``: array of struct(key, values, basis, attachments, evidence); ``colour``: of a swatch, else null."""
    some = lambda test: F.exists(properties, test)
    cites = lambda p: F.forall(p["attachments"], lambda k: k.between(1, renders)) & ~_repeats(p["attachments"])
    dominant, accents = _property(properties, "color"), _property(properties, "accent_color")
    return _listed(
        (F.size(properties) > MOST_PROPERTIES, "too many properties"),
        (some(lambda p: _outside(p["key"], PROPERTY_KEYS)), "unknown property"),
        (_repeats(F.transform(properties, lambda p: p["key"])), "a property stands twice"),
        (some(lambda p: _outside(p["basis"], BASES)), "unknown basis"),
        (some(lambda p: (F.size(p["values"]) == 0) | (F.size(p["values"]) > MOST_VALUES) | _repeats(p["values"])), "values must be one to six and differ"),
        (some(lambda p: F.exists(p["values"], lambda v: _bad_text(v, 70))), "a value is no text of 70"),
        (some(lambda p: p["key"].isin(*DIRECTION_KEYS) & F.exists(p["values"], lambda v: ~v.isin(*DIRECTIONS))), "unknown direction"),
        (some(lambda p: (p["key"] == "stroke") & F.exists(p["values"], lambda v: ~v.isin(*STROKES))), "unknown stroke"),
        (some(lambda p: p["key"].isin("color", "accent_color") & F.exists(p["values"], lambda v: ~v.isin(*COLOURS))), "unknown colour"),
        (some(lambda p: ~cites(p)), "unknown or repeated attachment"),
        (some(lambda p: (p["basis"] == "render") != (F.size(p["attachments"]) > 0)), "attachments go with the render basis alone"),
        (some(lambda p: _bad_text(p["evidence"], 220)), "evidence is no text of 220"),
        (dominant.isNotNull() & (F.size(dominant["values"]) != 1), "one dominant colour"),
        (dominant.isNotNull() & (dominant["basis"] != F.when(colour.isNull(), "render").otherwise("identity")), "the dominant colour's basis"),
        ((dominant["basis"] == "render") & (F.size(dominant["attachments"]) != renders), "the dominant colour must be seen in every render"),
        (accents["basis"] != "render", "an accent colour needs a render"),
        (dominant.isNotNull() & F.arrays_overlap(accents["values"], dominant["values"]), "an accent repeats the dominant colour"),
        (colour.isNotNull() & ~F.coalesce((dominant["basis"] == "identity") & (dominant["values"] == F.array(colour)), F.lit(False)), "the fixed colour must be kept"),
    )


def record_errors(records: DataFrame) -> DataFrame:
    """Records with ``errors``.

    Columns: entity_id, status, description struct(identity, appearance, meaning), meaning_evidence struct(basis, source,
    evidence), names array of struct(name, basis, source, evidence), family, subfamily, subfamily_basis, collections,
    properties, uncertainties; and of the entity: entity struct(entity_id, name), fixed struct(family, subfamily,
    subfamily_gap), renders (how many), colour.
    """
    c, d, names = F.col, F.col("description"), F.col("names")
    meant, renders = F.col("meaning_evidence"), F.col("renders")
    prose = [(d[f], f) for f in ("identity", "appearance", "meaning")]
    official = F.trim(c("entity.name"))
    shouted = (F.size(F.split(official, r"\s+")) > 1) & (official == F.upper(official))
    told = lambda text: F.contains(F.concat(F.lit(" "), text_key(text), F.lit(" ")), F.concat(F.lit(" "), text_key(official), F.lit(" ")))
    whole = F.regexp_extract(official, "(UPWARDS|DOWNWARDS) AND (LEFTWARDS|RIGHTWARDS) ARROW", 0)
    way = F.lower(F.regexp_replace(F.replace(whole, F.lit(" ARROW"), F.lit("")), "WARDS", ""))
    both = F.split(way, " and ")
    direction, path, head = (_property(F.col("properties"), k) for k in ("direction", "path_directions", "head_direction"))
    compound, curved = whole != "", F.contains(official, F.lit("CURVED"))
    commentary = r"(?i)\b(?:both|supplied|attached|provided|these|the two) (?:target |vendor |glyph )?(?:renders?|images?|screenshots?|fonts?)\b|\bshown (?:here|above|in the image)\b"
    hedge = r"(?i)\b(?:among other (?:related )?interpretations|depending on (?:the )?context|interpretations? may vary)\b"
    own = _listed(
        (~c("entity_id").eqNullSafe(c("entity.entity_id")), "entity_id differs from the entity's"),
        (_outside(c("status"), STATUSES), "unknown status"),
        *[(_bad_text(text, most, f != "identity"), f"description.{f} is no text of {most}") for (text, f), most in zip(prose, (180, 300, 260), strict=True)],
        (F.size(names) > MOST_NAMES, "too many names"),
        (F.exists(names, lambda n: _outside(n["basis"], NAME_BASES)), "a name needs the identity or convention basis"),
        (F.exists(names, lambda n: _bad_text(n["name"], 100) | (text_key(n["name"]) == "")), "a name is no lexical text of 100"),
        (F.exists(names, lambda n: _bad_text(n["source"], 180) | _bad_text(n["evidence"], 300)), "a name lacks source or evidence"),
        (_repeats(F.transform(names, lambda n: text_key(n["name"]))), "a name stands twice"),
        (d["meaning"].isNull() & meant.isNotNull(), "evidence for no meaning"),
        (d["meaning"].isNotNull() & (meant.isNull() | (meant["basis"] != "convention") | _bad_text(meant["source"], 180) | _bad_text(meant["evidence"], 300)), "a meaning needs conventional evidence"),
        *[(text.rlike(commentary), f"description.{f} speaks of its making") for text, f in prose],
        *[(text.rlike(r"(?i)\bU\+[0-9A-F]{4,6}\b|\bUnicode\b"), f"description.{f} holds Unicode metadata") for text, f in prose],
        *[(shouted & F.contains(text, official), f"description.{f} recites the official name") for text, f in prose],
        *[(text.rlike(hedge), f"description.{f} hedges") for text, f in prose],
        ((F.size(F.split(text_key(official), " ")) >= 4) & told(d["identity"]) & told(d["appearance"]), "appearance repeats the name of identity"),
        (d["appearance"].isNotNull() & (renders == 0), "appearance needs a render"),
        (F.size("collections") > 0, "collections are not assigned here"),
        (compound & ~F.coalesce(F.array_contains(direction["values"], F.array_join(both, "-")), F.lit(False)), "the name's compound direction is missing"),
        (compound & curved & ~F.coalesce(F.size(F.array_except(both, path["values"])) == 0, F.lit(False)), "a curved arrow keeps both path directions"),
        (compound & curved & head.isNull(), "a curved arrow needs a head direction"),
        (F.size("uncertainties") > MOST_UNCERTAINTIES, "too many uncertainties"),
        ((c("status") == "ready") & (F.size("uncertainties") > 0), "what is uncertain needs review"),
    )
    errors = F.concat(own, taxonomy_errors(c("family"), c("subfamily"), c("subfamily_basis"), c("fixed"), renders), property_errors(F.col("properties"), renders, c("colour")))
    return records.withColumn("errors", errors)


def fact_references(record: Column) -> Column:
    """Map of every path by which a fact may be cited to its numbered path: description fields that are set, names, properties by place and by key."""
    entry = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    fields = [F.when(record["description"][f].isNotNull(), entry(F.lit(f"description.{f}"), F.lit(f"description.{f}"))) for f in ("identity", "appearance", "meaning")]
    place = lambda group, i: F.concat(F.lit(f"{group}."), i.cast("string"))
    names = F.transform(record["names"], lambda n, i: entry(place("names", i), place("names", i)))
    numbered = F.transform(record["properties"], lambda p, i: entry(place("properties", i), place("properties", i)))
    keyed = F.transform(record["properties"], lambda p, i: entry(F.concat(F.lit("properties."), p["key"]), place("properties", i)))
    whole = F.array_compact(F.array(F.when(F.size(record["properties"]) > 0, entry(F.lit("properties"), F.lit("properties")))))
    return F.map_from_entries(F.concat(F.array_compact(F.array(*fields)), names, whole, numbered, keyed))


def review_paths(record: Column) -> Column:
    """What a factual review must check: a chosen subfamily, the description (its meaning even where null), names and properties."""
    fixed = F.array_compact(
        F.array(
            F.when(record["subfamily_basis"] == "model", "subfamily"),
            F.when(record["description"]["identity"].isNotNull(), "description.identity"),
            F.when(record["description"]["appearance"].isNotNull(), "description.appearance"),
            F.lit("description.meaning"),
            F.lit("names"),
        )
    )
    place = lambda group: lambda x, i: F.concat(F.lit(f"{group}."), i.cast("string"))
    return F.concat(fixed, *[F.transform(record[g], place(g)) for g in ("names", "properties")])


def review_errors(reviews: DataFrame) -> DataFrame:
    """Factual reviews (entity_id, checks array of struct(path, verdict, basis, attachments, evidence), record, renders)
    with ``errors`` and ``accepted``: a ready record all of whose checks are supported."""
    checks, record, renders = F.col("checks"), F.col("record"), F.col("renders")
    paths = review_paths(record)
    some = lambda test: F.exists(checks, test)
    number = lambda k: F.element_at(F.split(k["path"], r"\."), -1).try_cast("int")
    is_name, is_property = (lambda k: k["path"].startswith("names.")), (lambda k: k["path"].startswith("properties."))
    supported = lambda k, path: (k["verdict"] == "supported") & (k["path"] == path)
    claimed = lambda k: F.get(record["properties"], number(k))
    errors = _listed(
        (~F.col("entity_id").eqNullSafe(record["entity_id"]), "entity_id differs from the record's"),
        (some(lambda k: ~F.array_contains(paths, k["path"])), "unknown path"),
        (some(lambda k: _outside(k["verdict"], VERDICTS)), "unknown verdict"),
        (some(lambda k: _outside(k["basis"], REVIEW_BASES)), "unknown basis"),
        (some(lambda k: ~F.forall(k["attachments"], lambda a: a.between(1, renders)) | _repeats(k["attachments"])), "unknown or repeated attachment"),
        (some(lambda k: (k["basis"] == "render") != (F.size(k["attachments"]) > 0)), "attachments go with the render basis alone"),
        (some(lambda k: (k["verdict"] == "supported") & (k["basis"] == "insufficient")), "insufficient evidence supports nothing"),
        (some(lambda k: (supported(k, "subfamily") | supported(k, "description.appearance")) & (k["basis"] != "render")), "what is seen needs a render"),
        (some(lambda k: (supported(k, "description.meaning") | supported(k, "names")) & (k["basis"] != "convention")), "meaning and names need convention"),
        (some(lambda k: is_name(k) & (k["verdict"] == "supported") & (k["basis"] != F.get(record["names"], number(k))["basis"])), "a name is checked on its own basis"),
        (
            some(lambda k: is_property(k) & (k["verdict"] == "supported") & (claimed(k)["basis"] == "render") & ((k["basis"] != "render") | (F.size(F.array_except(claimed(k)["attachments"], k["attachments"])) > 0))),
            "a visual property is checked on every attachment it claims",
        ),
        (some(lambda k: _bad_text(k["evidence"], 300)), "evidence is no text of 300"),
        (_repeats(F.transform(checks, lambda k: k["path"])) | (F.size(F.array_except(paths, F.transform(checks, lambda k: k["path"]))) > 0), "every path is checked once"),
    )
    accepted = (F.size("errors") == 0) & (record["status"] == "ready") & F.forall(checks, lambda k: k["verdict"] == "supported")
    return reviews.withColumn("errors", errors).withColumn("accepted", accepted)


def wording_warnings(path: Column, evidence: Column, attachments: Column, hashes: Column) -> Column:
    """Is evidence that speaks of several renders backed by fewer than two distinct ones?"""
    cited = F.array_distinct(F.array_compact(F.transform(attachments, lambda k: F.get(hashes, k.cast("int") - 1))))
    several = evidence.rlike(r"(?i)\b(?:both|two|independent|shared|all) (?:target |vendor |glyph )?(?:renders?|images?|fonts?|sources?|attachments?)\b")
    return F.when(several & (F.size(cited) < 2), F.concat(path, F.lit(" speaks of several renders")))


def discovery_errors(rows: DataFrame) -> DataFrame:
    """Discovered candidates (entity_id, candidates array of struct(id, phrase, intent, register, supports), record) with
    ``errors``, and each candidate's supports as numbered paths."""
    candidates, record = F.col("candidates"), F.col("record")
    references = fact_references(record)
    some = lambda test: F.exists(candidates, test)
    spelled = F.transform(F.filter(candidates, lambda k: k["intent"] == "name"), lambda k: text_key(k["phrase"]))
    unspelled = F.exists(record["names"], lambda n: ~F.array_contains(spelled, text_key(n["name"])))
    means = F.exists(candidates, lambda k: (k["intent"] == "use") & F.array_contains(k["supports"], "description.meaning"))
    errors = _listed(
        (~F.col("entity_id").eqNullSafe(record["entity_id"]), "entity_id differs from the record's"),
        (F.size(candidates) > MOST_CANDIDATES, "too many candidates"),
        (some(lambda k: k["id"].isNull() | ~k["id"].rlike("^[a-zA-Z0-9_-]{1,32}$")), "an id is no simple identifier"),
        (_repeats(F.transform(candidates, lambda k: k["id"])), "an id stands twice"),
        (some(lambda k: _outside(k["intent"], INTENTS)), "unknown intent"),
        (some(lambda k: _outside(k["register"], REGISTERS)), "unknown register"),
        (some(lambda k: _bad_text(k["phrase"], 100)), "a phrase is no text of 100"),
        (some(lambda k: (F.size(k["supports"]) == 0) | (F.size(k["supports"]) > MOST_SUPPORTS)), "a candidate cites one to four facts"),
        (some(lambda k: F.exists(k["supports"], lambda s: ~F.map_contains_key(references, s))), "a cited fact is missing"),
        (unspelled, "a name is spelled by no name candidate"),
        (record["description"]["meaning"].isNotNull() & ~means, "the meaning is used by no candidate"),
    )
    numbered = F.transform(candidates, lambda k: k.withField("supports", F.array_distinct(F.transform(k["supports"], lambda s: F.try_element_at(references, s)))))
    return rows.withColumn("errors", errors).withColumn("candidates", numbered)


def lexical_matches(candidates: Column, baseline: Column) -> Column:
    """For each candidate (id, phrase) the baseline entries (id, phrase) with its exact wording, those that hold it, and its doubles."""
    ids = lambda rows: F.transform(rows, lambda r: r["id"])
    spaced = lambda p: F.concat(F.lit(" "), text_key(p), F.lit(" "))
    return F.transform(
        candidates,
        lambda k: F.struct(
            k["id"].alias("candidate_id"),
            ids(F.filter(baseline, lambda b: text_key(b["phrase"]) == text_key(k["phrase"]))).alias("exact"),
            ids(F.filter(baseline, lambda b: F.contains(spaced(b["phrase"]), spaced(k["phrase"])))).alias("contained"),
            ids(F.filter(candidates, lambda o: (o["id"] != k["id"]) & (text_key(o["phrase"]) == text_key(k["phrase"])))).alias("doubles"),
        ),
    )


def vocabulary_review(rows: DataFrame) -> DataFrame:
    """Reviews of candidates with ``errors``; a candidate that the baseline has word for word is ``existing`` by rule.

    Columns: entity_id, candidates, baseline array of struct(id, phrase), checks array of struct(candidate_id, relevance,
    baseline_relation, baseline_ids, group_id), groups array of struct(id, intent, description, representative_id).
    """
    checks, groups, candidates, baseline = (F.col(c) for c in ("checks", "groups", "candidates", "baseline"))
    eligible = F.filter(checks, lambda k: k["relevance"].isin("direct", "related"))
    known = F.transform(baseline, lambda b: b["id"])
    asked, given = F.transform(candidates, lambda k: k["id"]), F.transform(checks, lambda k: k["candidate_id"])
    members = lambda g: F.filter(eligible, lambda k: k["group_id"] == g["id"])
    stands = lambda g: F.get(F.filter(members(g), lambda k: k["candidate_id"] == g["representative_id"]), F.lit(0))
    phrase = lambda k: text_key(F.get(F.filter(candidates, lambda c: c["id"] == k["candidate_id"]), F.lit(0))["phrase"])
    errors = _listed(
        (F.size(F.array_except(given, asked)) > 0, "unknown candidate"),
        (_repeats(given) | (F.size(F.array_except(asked, given)) > 0), "every candidate is reviewed once"),
        (F.exists(checks, lambda k: _outside(k["relevance"], RELEVANCES)), "unknown relevance"),
        (F.exists(checks, lambda k: _outside(k["baseline_relation"], RELATIONS)), "unknown relation"),
        (F.exists(checks, lambda k: _repeats(k["baseline_ids"]) | (F.size(F.array_except(k["baseline_ids"], known)) > 0)), "unknown or repeated baseline entry"),
        (F.exists(checks, lambda k: k["baseline_relation"].isin("existing", "rewording") & (F.size(k["baseline_ids"]) == 0)), "what overlaps must be named"),
        (F.exists(checks, lambda k: k["relevance"].isin("direct", "related") != (F.coalesce(k["group_id"], F.lit("")) != "")), "grounded candidates alone have a group"),
        (F.exists(groups, lambda g: g["id"].isNull() | ~g["id"].rlike("^[a-zA-Z0-9_-]{1,32}$") | _outside(g["intent"], INTENTS) | _bad_text(g["description"], 200)), "a group is malformed"),
        (F.exists(groups, lambda g: stands(g).isNull()), "a representative is no member of its group"),
        (F.exists(groups, lambda g: F.exists(members(g), lambda k: k["relevance"] == "direct") & (stands(g)["relevance"] != "direct")), "a direct member must represent its group"),
        (_repeats(F.transform(groups, lambda g: g["id"])), "a group stands twice"),
        (F.size(F.array_except(F.transform(eligible, lambda k: k["group_id"]), F.transform(groups, lambda g: g["id"]))) > 0, "a candidate's group is missing"),
        (F.exists(eligible, lambda k: F.exists(eligible, lambda o: (phrase(o) == phrase(k)) & (o["group_id"] != k["group_id"]))), "one phrase stands in two groups"),
    )
    exact = lambda k: F.get(F.filter(lexical_matches(candidates, baseline), lambda m: m["candidate_id"] == k["candidate_id"]), F.lit(0))["exact"]

    def ruled(k: Column) -> Column:
        has = F.coalesce(F.size(exact(k)) > 0, F.lit(False))
        own = k.withField("overridden", has & (k["baseline_relation"] != "existing"))
        return own.withField("baseline_ids", F.when(has, exact(k)).otherwise(k["baseline_ids"])).withField("baseline_relation", F.when(has, F.lit("existing")).otherwise(k["baseline_relation"]))

    return rows.withColumn("errors", errors).withColumn("checks", F.transform(checks, ruled))


def group_relation(relations: Column) -> Column:
    """The relation of a group from those of its members: existing before rewording before all proposed before uncertain."""
    return (
        F.when(F.array_contains(relations, "existing"), "existing")
        .when(F.array_contains(relations, "rewording"), "rewording")
        .when(F.forall(relations, lambda r: r == "proposed-new-intent"), "proposed-new-intent")
        .otherwise("uncertain")
    )


def ranking_errors(rows: DataFrame) -> DataFrame:
    """Adjudication votes (candidates array, ranking array of struct(entity_id, p)) with ``errors`` and probabilities that add up to 1."""
    ranking, candidates = F.col("ranking"), F.col("candidates")
    ids = F.transform(ranking, lambda r: r["entity_id"])
    total = F.aggregate(ranking, F.lit(0.0), lambda a, r: a + r["p"])
    errors = _listed(
        (F.size(F.array_except(ids, candidates)) > 0, "an unknown candidate is ranked"),
        (_repeats(ids) | (F.size(F.array_except(candidates, ids)) > 0), "every candidate is ranked once"),
        (F.exists(ranking, lambda r: r["p"].isNull() | F.isnan(r["p"]) | ~r["p"].between(0, 1)), "a probability lies outside 0 to 1"),
        (~total.between(*RANKING_SUM), "probabilities do not add up to 1"),
    )
    scaled = F.when(F.size("errors") == 0, F.transform(ranking, lambda r: r.withField("p", r["p"] / total))).otherwise(ranking)
    return rows.withColumn("errors", errors).withColumn("ranking", scaled)


def verification_errors(rows: DataFrame, verdicts: tuple[str, ...]) -> DataFrame:
    """Verification votes (claim_ids array, reviews array of struct(claim_id, verdict, reason)) with ``errors``."""
    reviews, wanted = F.col("reviews"), F.col("claim_ids")
    ids = F.transform(reviews, lambda r: r["claim_id"])
    return rows.withColumn(
        "errors",
        _listed(
            (F.size(F.array_except(ids, wanted)) > 0, "an unknown claim is reviewed"),
            (_repeats(ids) | (F.size(F.array_except(wanted, ids)) > 0), "every claim is reviewed once"),
            (F.exists(reviews, lambda r: _outside(r["verdict"], verdicts)), "unknown verdict"),
            (F.exists(reviews, lambda r: _bad_text(r["reason"], 300)), "a reason is no text of 300"),
        ),
    )


#: What a grounded output must hold.
ANCHOR_SLOTS, CLEAR, GROUNDING_RENDERS = ("overall_form", "distinctive_feature"), "clear", 2
_GROUNDING = (
    "struct<adaptive_generation:struct<render_status:string>,recovery:struct<passed:boolean,picked_entity_id:string,expected_entity_id:string>,"
    "renders:array<struct<validation:struct<ink_hash:string>>>,accepted_claims:array<struct<evidence:struct<slot:string,vendor_support:map<string,bigint>>>>>"
)


def grounding_passes(output: Column, vendors: tuple[str, ...] = ("noto", "platform")) -> Column:
    """Does the JSON output of a grounding meet the gate: a clear generation, a recovery that picked what was expected, two
    renders with ink, and an accepted claim on form that every vendor supports?"""
    o = F.from_json(output, _GROUNDING)
    hashed = F.filter(o["renders"], lambda r: F.coalesce(r["validation"]["ink_hash"], F.lit("")) != "")
    told = lambda k: k["evidence"]["slot"].isin(*ANCHOR_SLOTS) & F.forall(F.array(*[F.lit(v) for v in vendors]), lambda v: F.coalesce(k["evidence"]["vendor_support"][v], F.lit(0)) >= 1)
    recovery = o["recovery"]
    same = F.coalesce(recovery["picked_entity_id"], F.lit("")) == F.coalesce(recovery["expected_entity_id"], F.lit(""))
    holds = (o["adaptive_generation"]["render_status"] == CLEAR) & recovery["passed"] & same & (F.size(o["renders"]) == GROUNDING_RENDERS) & (F.size(hashed) == GROUNDING_RENDERS) & F.exists(o["accepted_claims"], told)
    return F.coalesce(holds, F.lit(False))


def regated(checkpoints: DataFrame, stage: str, version: str) -> DataFrame:
    """Passed groundings of a version whose output (JSON) does not meet the gate are quarantined."""
    failing = (F.col("stage") == stage) & (F.col("version") == version) & (F.col("status") == "passed") & ~grounding_passes(F.col("output"))
    gate = F.lit("compatibility quarantine: adaptive two-call gate not met")
    return checkpoints.withColumns({"error": F.when(failing, gate).otherwise(F.col("error")), "status": F.when(failing, "quarantined").otherwise(F.col("status"))})
