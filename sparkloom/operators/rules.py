"""Row-level validation: rules as conditions, issues as an array, one row for each issue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import patterns
from sparkloom.functions.scalars import protected_tokens, unicode_strip, without_tokens
from sparkloom.registry import Tables, query


def issues(rules: Mapping[str, Column]) -> Column:
    """The codes of the rules that a row breaks, in the order of the rules."""
    return F.filter(F.array(*(F.when(broken, F.lit(code)) for code, broken in rules.items())), lambda x: x.isNotNull())


def first_issue(rules: Mapping[str, Column]) -> Column:
    """The first rule that a row breaks: for envelopes, whose rules stop early."""
    out = None
    for code, broken in rules.items():
        out = F.when(broken, F.lit(code)) if out is None else out.when(broken, F.lit(code))
    return out


def issue_table(rows: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    return rows.select(key, F.explode(issues(rules)).alias("issue"))


@query("v01_envelope_shape", "SELECT event_id, CASE WHEN props IS NULL THEN 'invalid_json' WHEN NOT STARTS_WITH(props, '{') THEN 'invalid_shape' WHEN event_id % 7 = 0 THEN 'unexpected_top_level_fields' END AS issue FROM events")
def envelope_shape(t: Tables) -> DataFrame:
    doc = F.when(F.col("event_id") % 7 == 0, F.regexp_replace("props", r"\}$", ', "extra": 1}')).otherwise(F.col("props"))
    keys = F.array_sort(F.json_object_keys(doc))
    rules = {"invalid_json": F.try_parse_json(doc).isNull(), "invalid_shape": keys.isNull(), "unexpected_top_level_fields": keys != F.array(F.lit("k"))}
    return t.events.select("event_id", first_issue(rules).alias("issue"))


@query("v02_envelope_identity", "SELECT conv_id, turn, 'batch_id_mismatch' AS issue FROM conversations WHERE conv_id % 10 = 3 UNION ALL SELECT conv_id, turn, 'wrong_schema_version' FROM conversations WHERE turn = 4")
def envelope_identity(t: Tables) -> DataFrame:
    sent = t.conversations.withColumn("said", F.when(F.col("conv_id") % 10 == 3, F.col("conv_id") + 1).otherwise(F.col("conv_id"))).withColumn("v", F.when(F.col("turn") == 4, 2).otherwise(1))
    rules = {"wrong_schema_version": F.col("v") != 1, "batch_id_mismatch": F.col("said") != F.col("conv_id")}
    return sent.select("conv_id", "turn", F.explode(issues(rules)).alias("issue"))


@query("v03_order_or_set_mismatch", "WITH a AS (SELECT o_custkey, LIST(o_orderkey ORDER BY o_orderkey) AS x, LIST(o_orderkey ORDER BY o_orderdate, o_orderkey) AS y FROM orders GROUP BY 1) SELECT o_custkey, x = y AS same_order FROM a")
def order_mismatch(t: Tables) -> DataFrame:
    a = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("x"), F.transform(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))), lambda s: s["o_orderkey"]).alias("y"))
    return a.select("o_custkey", (F.col("x") == F.col("y")).alias("same_order"))


@query("v04_source_hash", "SELECT p_partkey, 'source_hash_mismatch' AS issue FROM part WHERE p_partkey % 11 = 0")
def source_hash(t: Tables) -> DataFrame:
    said = F.sha2(F.when(F.col("p_partkey") % 11 == 0, F.lower("p_name")).otherwise(F.col("p_name")), 256)
    changed = F.when(F.col("p_partkey") % 11 == 0, F.concat("p_name", F.lit(" "))).otherwise(F.col("p_name"))
    return issue_table(t.part, "p_partkey", {"source_hash_mismatch": said != F.sha2(changed, 256)})


@query("v05_confidence", "SELECT o_orderkey, 'invalid_confidence' AS issue FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') UNION ALL SELECT o_orderkey, 'missing_review_reason' FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus = 'F'")
def confidence(t: Tables) -> DataFrame:
    c, reason = F.col("o_orderpriority"), F.when(F.col("o_orderstatus") != "F", "said")
    return issue_table(t.orders, "o_orderkey", {"invalid_confidence": ~c.isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "missing_review_reason": (c != "1-URGENT") & reason.isNull()})


@query("v06_glossary_set", "WITH g AS (SELECT o_custkey, LIST(o_orderpriority) AS x FROM orders GROUP BY 1) SELECT o_custkey, 'invalid_glossary_set' AS issue FROM g WHERE LEN(x) > 12 UNION ALL SELECT o_custkey, 'duplicate_glossary_definition' FROM g WHERE LEN(LIST_DISTINCT(x)) < LEN(x)")
def glossary_set(t: Tables) -> DataFrame:
    g = t.orders.groupBy("o_custkey").agg(F.collect_list("o_orderpriority").alias("x"))
    return issue_table(g, "o_custkey", {"invalid_glossary_set": ~F.size("x").between(1, 12), "duplicate_glossary_definition": F.size(F.array_distinct("x")) < F.size("x")})


@query("v07_protected_tokens", "SELECT doc_id, LEN(LIST_DISTINCT(REGEXP_EXTRACT_ALL(text, '[0-9]+(?:[.,][0-9]+)*'))) > 0 AND LEN(text) % 2 = 0 AS missing FROM documents")
def token_missing(t: Tables) -> DataFrame:
    """Every protected token of the source has to be in the target."""
    tokens = protected_tokens(F.col("text"), (r"[0-9]+(?:[.,][0-9]+)*",))
    target = F.when(F.length("text") % 2 == 0, F.regexp_replace("text", "[0-9]", "")).otherwise(F.col("text"))
    return t.documents.withColumn("target", target).withColumn("tokens", tokens).select("doc_id", F.exists("tokens", lambda x: ~F.contains(F.col("target"), x)).alias("missing"))


def text_issues(text: Column, protected: Column, *, any_script: Column | bool = False, english: Column | None = None) -> Column:
    """The codes of what is wrong with a translated text, in order.

    ``protected`` tokens must be in it, and neither they, the ``english`` words that
    are allowed nor names of species in brackets count as foreign. With
    ``any_script`` it need not have a Cyrillic letter.
    """
    rest = without_tokens(text, protected)
    if english is not None:
        rest = patterns.without_words(rest, english)
    rest = F.regexp_replace(rest, patterns.TAXON_IN_BRACKETS, "")
    rules = {
        "markup_detected": text.rlike(patterns.MARKUP),
        "control_character": text.rlike(patterns.CONTROL),
        "protected_token_missing": F.exists(protected, lambda x: ~F.contains(text, x)),
        "no_cyrillic": ~F.lit(any_script) & ~text.rlike(patterns.CYRILLIC) if isinstance(any_script, bool) else ~any_script & ~text.rlike(patterns.CYRILLIC),
        "mixed_alphabet_token": rest.rlike(patterns.MIXED_ALPHABET),
        "too_much_english": F.regexp_count(rest, F.lit(patterns.ASCII_WORD)) > 2,
    }
    return F.when(F.coalesce(unicode_strip(text), F.lit("")) == "", F.array(F.lit("empty_or_non_string"))).otherwise(issues(rules))


#: Units with sources and targets of all sorts, in words that Spark and DuckDB share; the targets break every rule.
ROLE = "CASE p_partkey % 6 WHEN 0 THEN 'glossary' WHEN 1 THEN 'note' WHEN 2 THEN 'example' WHEN 3 THEN 'xref_gloss' WHEN 4 THEN 'pos' ELSE 'label' END"
SOURCE = """CASE p_partkey % 6 WHEN 0 THEN 'press Ctrl+C in ' || p_name || ' USB' WHEN 1 THEN 'Latin: "' || p_name || '"' WHEN 2 THEN 'antecedent which ' || p_name || ' that these'
 WHEN 3 THEN p_name || ' (Felis catus), NASA' WHEN 4 THEN CASE WHEN p_partkey % 4 = 0 THEN ' Suru ' ELSE 'noun' END ELSE p_name END"""
TARGET = f"""CASE p_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN 'слово <b>' || p_name WHEN 3 THEN 'слово' || chr(7) || ({SOURCE}) WHEN 4 THEN ({SOURCE}) WHEN 5 THEN 'слово ' || ({SOURCE})
 WHEN 6 THEN 'словоabc ' || ({SOURCE}) WHEN 7 THEN 'слово one two three four' WHEN 8 THEN 'слово (Felis catus) and NASA Ctrl+C ' || p_name WHEN 9 THEN 'する' WHEN 10 THEN 'слово [x](y) ' || ({SOURCE})
 WHEN 11 THEN 'слово which that THESE ' || p_name ELSE 'слово ' || SPLIT_PART(p_name, ' ', 1) END"""
TOKEN = "CASE WHEN p_partkey % 3 = 0 THEN SPLIT_PART(p_name, ' ', 1) END"
REQUIRED = f"CASE WHEN p_partkey % 7 = 0 THEN 'required' WHEN p_partkey % 7 = 1 THEN ({TARGET}) END"


def unit_texts(t: Tables) -> DataFrame:
    cols = {"role": ROLE, "source": SOURCE, "target": TARGET, "token": TOKEN, "required": REQUIRED}
    return t.part.select("p_partkey", *(F.expr(v).alias(k) for k, v in cols.items()))


UNITS_SQL = f"u AS (SELECT p_partkey, {ROLE} AS role, {SOURCE} AS source, {TARGET} AS target, {TOKEN} AS token, {REQUIRED} AS required FROM part)"


def issues_sql(protected: str, any_script: str, english: str = "[]") -> str:
    """The rules again, for DuckDB: words are told apart by splitting, as its boundaries know ASCII alone."""
    rest = f"LIST_REDUCE(LIST_PREPEND(target, {protected}), lambda a, b: REPLACE(a, b, ''))"
    rest = f"LIST_REDUCE(LIST_PREPEND({rest}, {english}), lambda a, b: REGEXP_REPLACE(a, '(?i)\\b' || b || '\\b', '', 'g'))"
    rest = f"REGEXP_REPLACE({rest}, '(\\(){patterns.TAXON}(\\s*[;,)])', '\\1\\2', 'g')"
    return f"""CASE WHEN COALESCE(TRIM(target), '') = '' THEN ['empty_or_non_string'] ELSE LIST_FILTER([
 CASE WHEN REGEXP_MATCHES(target, '{patterns.MARKUP}') THEN 'markup_detected' END, CASE WHEN REGEXP_MATCHES(target, '{patterns.CONTROL}') THEN 'control_character' END,
 CASE WHEN LEN(LIST_FILTER({protected}, lambda x: NOT CONTAINS(target, x))) > 0 THEN 'protected_token_missing' END, CASE WHEN NOT {any_script} AND NOT REGEXP_MATCHES(target, '{patterns.CYRILLIC}') THEN 'no_cyrillic' END,
 CASE WHEN REGEXP_MATCHES({rest}, '{patterns.MIXED_ALPHABET}') THEN 'mixed_alphabet_token' END,
 CASE WHEN LEN(LIST_FILTER(REGEXP_EXTRACT_ALL({rest}, '[\\p{{L}}\\p{{N}}_]+'), lambda w: REGEXP_FULL_MATCH(w, '[A-Za-z]{{3,}}'))) > 2 THEN 'too_much_english' END], lambda x: x IS NOT NULL) END"""


OWN_TOKEN = "(CASE WHEN token IS NULL THEN [] ELSE [token] END)"


@query("v08_text_rules", f"WITH {UNITS_SQL} SELECT p_partkey, UNNEST({issues_sql(OWN_TOKEN, 'FALSE')}) AS issue FROM u")
def text_rules(t: Tables) -> DataFrame:
    """The rules as they are, without any exception."""
    u = unit_texts(t)
    return u.select("p_partkey", F.explode(text_issues(F.col("target"), F.array_compact(F.array("token")))).alias("issue"))


def scalar_unit_issues(role: Column, source: Column, target: Column, tokens: Column, required: Column) -> Column:
    """The rules with the exceptions that a unit's role, source and approved target make."""
    none = F.array().cast("array<string>")
    origin = F.regexp_extract(unicode_strip(source), patterns.LANGUAGE_ORIGIN, 1)
    protected = F.concat(
        F.when(required.isNull(), tokens).otherwise(none),
        patterns.found(source, patterns.KEY_CHORD),
        patterns.found(source, patterns.ACRONYM),
        F.when(role == "xref_gloss", patterns.binomials(source)).otherwise(none),
        F.when((role == "note") & (origin != ""), F.array(origin)).otherwise(none),
    )
    grammar_label = (role == "pos") & (F.lower(unicode_strip(source)) == "suru")
    any_script = F.coalesce(target == required, F.lit(False)) | grammar_label
    english = F.when((role == "example") & F.lower(source).contains("antecedent"), patterns.found(source, patterns.GRAMMAR_WORD)).otherwise(none)
    return text_issues(target, protected, any_script=any_script, english=english)


CHORDS = f"REGEXP_EXTRACT_ALL(source, '{patterns.KEY_CHORD}')"
ACRONYMS = f"REGEXP_EXTRACT_ALL(source, '{patterns.ACRONYM}')"
#: The one name of a species in these sources is behind a bracket.
TAXA = "(CASE WHEN role = 'xref_gloss' AND source LIKE '%(Felis catus)%' THEN ['Felis catus'] ELSE [] END)"
ORIGIN = "(CASE WHEN role = 'note' THEN [REGEXP_EXTRACT(source, '\"([^\"]+)\"', 1)] ELSE [] END)"
PROTECTED = f"LIST_CONCAT(LIST_CONCAT((CASE WHEN required IS NULL THEN {OWN_TOKEN} ELSE [] END), LIST_CONCAT({CHORDS}, {ACRONYMS})), LIST_CONCAT({TAXA}, {ORIGIN}))"
ANY_SCRIPT = "(COALESCE(target = required, FALSE) OR (role = 'pos' AND LOWER(TRIM(source)) = 'suru'))"
ENGLISH = "(CASE WHEN role = 'example' THEN ['which', 'that', 'these'] ELSE [] END)"


@query("v09_rule_exceptions", f"WITH {UNITS_SQL} SELECT p_partkey, role, UNNEST({issues_sql(PROTECTED, ANY_SCRIPT, ENGLISH)}) AS issue FROM u")
def exceptions(t: Tables) -> DataFrame:
    """Key chords, acronyms, species, names of languages' words, grammar words, labels and approved targets."""
    u = unit_texts(t)
    found = scalar_unit_issues(F.col("role"), F.col("source"), F.col("target"), F.array_compact(F.array("token")), F.col("required"))
    return u.select("p_partkey", "role", F.explode(found).alias("issue"))


def definition_issues(source: Column, definitions: Column, tokens: Column) -> Column:
    """array<struct<place, issue>> of a glossary set: place -1 for the set itself."""
    acronyms = patterns.found(source, patterns.ACRONYM)
    whole = F.array_join(definitions, " ")
    lost = F.exists(F.concat(tokens, acronyms), lambda x: ~F.contains(whole, x))
    one = lambda place, code: F.struct(place.cast("int").alias("place"), code.alias("issue"))
    of_set = F.array_compact(F.array(F.when(lost, one(F.lit(-1), F.lit("protected_token_missing")))))

    def each(text: Column, place: Column) -> Column:
        exact = text.rlike(patterns.ACRONYM_ONLY) & F.contains(source, text) & whole.rlike(patterns.CYRILLIC)
        return F.transform(text_issues(text, F.filter(acronyms, lambda x: F.contains(text, x)), any_script=exact), lambda code: one(place, code))

    return F.concat(of_set, F.flatten(F.transform(definitions, each)))


@query("v09_glossary_definitions", "SELECT p_partkey, CAST(-1 AS INT) AS place, 'protected_token_missing' AS issue FROM part WHERE p_partkey % 4 = 1 UNION ALL SELECT p_partkey, 0, 'no_cyrillic' FROM part WHERE p_partkey % 4 IN (1, 2) UNION ALL SELECT p_partkey, 1, 'no_cyrillic' FROM part WHERE p_partkey % 4 IN (1, 2) UNION ALL SELECT p_partkey, 0, 'empty_or_non_string' FROM part WHERE p_partkey % 4 = 3")
def glossary_definitions(t: Tables) -> DataFrame:
    """An acronym of the source may be a definition by itself, beside one in Cyrillic letters."""
    kind = F.col("p_partkey") % 4
    first = F.when(kind == 0, F.lit("шина")).when(kind == 1, "bus").when(kind == 2, "NASA").otherwise(" ")
    second = F.when(kind == 1, F.lit("wire")).when(kind == 2, "ab").when(kind == 3, "шина USB NASA").otherwise("USB")
    source = F.when(kind == 0, F.lit("a USB")).when(kind == 2, "NASA ab").otherwise("USB, NASA")
    found = definition_issues(source, F.array(first, second), F.array().cast("array<string>"))
    return t.part.select("p_partkey", F.explode(found).alias("x")).select("p_partkey", "x.*")


#: A review of each line: by whom, of what, and what it says.
REVIEW = {
    "fields": "CASE WHEN l_quantity = 50 THEN 'unit_id,decision' ELSE 'decision,reason,replacement_target,source_sha256,unit_id' END",
    "translator": "l_partkey % 7", "reviewer": "l_suppkey % 7",
    "said_hash": "CASE WHEN l_quantity = 49 THEN 'x' ELSE 'h' || l_partkey END", "source_hash": "'h' || l_partkey",
    "decision": "CASE WHEN l_returnflag = 'A' THEN 'accept' WHEN l_returnflag = 'R' THEN 'replace' WHEN l_linenumber = 4 THEN 'maybe' ELSE 'needs_adjudication' END",
    "replacement": "CASE WHEN l_returnflag = 'R' THEN CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'слово ' || l_partkey WHEN 2 THEN 'one word' ELSE 'слово' END END",
    "token": "CAST(l_partkey AS VARCHAR(20))", "status": "CASE WHEN l_linestatus = 'F' THEN 'reviewed' ELSE 'translated' END",
}
REVIEW_FIELDS = "decision,reason,replacement_target,source_sha256,unit_id"


@query(
    "v10_review_rules",
    f"WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(f'{v} AS {k}' for k, v in REVIEW.items())} FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN fields <> '{REVIEW_FIELDS}' THEN 'unexpected_fields' "
    "WHEN reviewer = translator THEN 'reviewer_is_translator' WHEN said_hash <> source_hash THEN 'hash_mismatch' WHEN decision NOT IN ('accept', 'replace', 'needs_adjudication') THEN 'invalid_decision' "
    "WHEN decision = 'replace' AND (replacement IS NULL OR NOT REGEXP_MATCHES(replacement, '[а-я]')) THEN 'invalid_replacement' WHEN decision = 'replace' AND NOT CONTAINS(replacement, token) THEN 'lost_token' "
    "WHEN status = 'reviewed' THEN 'already_reviewed' WHEN decision = 'needs_adjudication' THEN 'adjudicate' ELSE 'accepted' END AS outcome FROM r",
)
def review_rules(t: Tables) -> DataFrame:
    """What becomes of each review: the first rule it breaks, or what it decides. A review that comes late changes nothing."""
    r = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *(F.expr(v).alias(k) for k, v in REVIEW.items()))
    replace = F.col("decision") == "replace"
    outcome = first_issue({
        "unexpected_fields": F.col("fields") != REVIEW_FIELDS,
        "reviewer_is_translator": F.col("reviewer") == F.col("translator"),
        "hash_mismatch": F.col("said_hash") != F.col("source_hash"),
        "invalid_decision": ~F.col("decision").isin("accept", "replace", "needs_adjudication"),
        "invalid_replacement": replace & (F.size(text_issues(F.col("replacement"), F.array().cast("array<string>"))) > 0),
        "lost_token": replace & ~F.contains("replacement", "token"),
        "already_reviewed": F.col("status") == "reviewed",
        "adjudicate": F.col("decision") == "needs_adjudication",
    })
    return r.select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce(outcome, F.lit("accepted")).alias("outcome"))


ADJUDICATION = {
    "fields": "CASE WHEN o_orderkey % 19 = 0 THEN 'unit_id' ELSE 'batch_id,decision,reason,target_text,unit_id' END",
    "decision": "CASE o_orderkey % 5 WHEN 0 THEN 'replace' WHEN 1 THEN 'drop' ELSE 'accept_candidate' END",
    "reason": "CASE WHEN o_orderkey % 11 = 0 THEN '  ' WHEN o_orderkey % 11 = 1 THEN NULL ELSE 'said' END",
    "candidate": "'слово ' || o_custkey",
    "target": "CASE o_orderkey % 7 WHEN 0 THEN 'слово ' || o_custkey || '!' WHEN 1 THEN 'word ' || o_custkey WHEN 2 THEN '<i>слово</i> ' || o_custkey WHEN 3 THEN 'слово' ELSE 'слово ' || o_custkey END",
    "token": "CAST(o_custkey AS VARCHAR(20))",
    "conflict": "o_orderstatus <> 'P'", "seen": "o_orderpriority = '1-URGENT'",
}


@query(
    "v11_adjudication_rules",
    f"WITH a AS (SELECT o_orderkey, {', '.join(f'{v} AS {k}' for k, v in ADJUDICATION.items())} FROM orders) SELECT o_orderkey, CASE WHEN fields <> 'batch_id,decision,reason,target_text,unit_id' THEN 'unexpected_fields' WHEN decision NOT IN ('accept_candidate', 'replace') THEN 'invalid_decision' "
    "WHEN COALESCE(TRIM(reason), '') = '' THEN 'no_reason' WHEN NOT conflict THEN 'no_conflict' WHEN NOT REGEXP_MATCHES(target, '[а-я]') OR REGEXP_MATCHES(target, '<[a-z/]+>') THEN 'invalid_target' "
    "WHEN decision = 'accept_candidate' AND target <> candidate THEN 'not_the_candidate' WHEN NOT CONTAINS(target, token) THEN 'lost_token' WHEN seen THEN 'already_applied' ELSE 'adjudicated' END AS outcome FROM a",
)
def adjudication(t: Tables) -> DataFrame:
    """What becomes of the decision on an open conflict of reviews."""
    a = t.orders.select("o_orderkey", *(F.expr(v).alias(k) for k, v in ADJUDICATION.items()))
    x = F.col("target")
    outcome = first_issue({
        "unexpected_fields": F.col("fields") != "batch_id,decision,reason,target_text,unit_id",
        "invalid_decision": ~F.col("decision").isin("accept_candidate", "replace"),
        "no_reason": F.coalesce(unicode_strip(F.col("reason")), F.lit("")) == "",
        "no_conflict": ~F.col("conflict"),
        "invalid_target": ~x.rlike(patterns.CYRILLIC) | x.rlike(patterns.MARKUP),
        "not_the_candidate": (F.col("decision") == "accept_candidate") & (x != F.col("candidate")),
        "lost_token": ~F.contains(x, F.col("token")),
        "already_applied": F.col("seen"),
    })
    return a.select("o_orderkey", F.coalesce(outcome, F.lit("adjudicated")).alias("outcome"))


def label_issue(label: Column, source_label: Column, description: Column, source_description: Column, confidence: Column, reason: Column) -> Column:
    """The first rule that the translation of a tag breaks, or null."""
    blank = lambda c: F.coalesce(unicode_strip(c), F.lit("")) == ""
    endings = F.create_map(*(F.lit(x) for pair in patterns.ENDING_KANA.items() for x in pair))
    kana = F.try_element_at(endings, F.regexp_extract(source_description, "with '([^']+)' ending", 1))
    forms = F.lit(False)
    for form, own in patterns.SOURCE_FORM_KANA.items():
        forms = forms | (F.contains(source_description, F.lit(form)) & ~F.contains(description, F.lit(own)))
    high = confidence == "high"
    return first_issue({
        "empty": blank(label) | blank(description),
        "label_not_cyrillic": (label != "★") & ~label.rlike(patterns.CYRILLIC),
        "star_mismatch": (label == "★") & (source_label != "★"),
        "label_too_long": F.length(label) > 16,
        "tooltip_not_cyrillic": ~description.rlike(patterns.CYRILLIC),
        "tooltip_has_latin": description.rlike("[A-Za-z]{2,}"),
        "tooltip_shortened": description.rlike(patterns.TOOLTIP_ABBREVIATION),
        "label_not_shortened": label.rlike(patterns.FULL_POS_LABEL),
        "ending_kana_missing": kana.isNotNull() & ~F.contains(description, kana),
        "form_kana_missing": forms,
        "invalid_confidence": ~F.coalesce(confidence.isin("high", "medium", "low"), F.lit(False)),
        "reason_mismatch": (high & reason.isNotNull()) | (~high & blank(reason)),
    })


#: (label, source label, tooltip, source tooltip, confidence, reason, what is wrong): each breaks one rule, or none.
LABELS = [
    ("сущ.", "noun", "имя", "a name", "high", None, None), (" ", "noun", "имя", "a name", "high", None, "empty"), ("n", "noun", "имя", "a name", "high", None, "label_not_cyrillic"),
    ("★", "★", "частое", "common", "high", None, None), ("★", "noun", "частое", "common", "high", None, "star_mismatch"), ("очень длинный ярлык", "x", "имя", "a name", "high", None, "label_too_long"),
    ("гл.", "verb", "verb", "verb", "high", None, "tooltip_not_cyrillic"), ("гл.", "verb", "слово of", "verb", "high", None, "tooltip_has_latin"), ("гл.", "verb", "это гл. слово", "verb", "high", None, "tooltip_shortened"),
    ("Глагол", "verb", "слово", "verb", "high", None, "label_not_shortened"), ("гл.", "verb", "слово на ぶ", "verb with 'bu' ending", "high", None, None), ("гл.", "verb", "слово на ぶ", "verb with 'gu' ending", "high", None, "ending_kana_missing"),
    ("гл.", "verb", "слово くれる", "kureru verb", "high", None, None), ("гл.", "verb", "слово", "suru verb", "high", None, "form_kana_missing"), ("гл.", "verb", "слово", "verb", "sure", None, "invalid_confidence"),
    ("гл.", "verb", "слово", "verb", "low", None, "reason_mismatch"), ("гл.", "verb", "слово", "verb", "high", "why", "reason_mismatch"), ("гл.", "verb", "слово", "verb", "medium", "why", None), ("гл.", "verb", "слово", "verb", None, "why", "invalid_confidence"),
]


@query("v12_label_rules", "SELECT p_partkey, CASE p_partkey % " + str(len(LABELS)) + "".join(f" WHEN {k} THEN '{x[6]}'" for k, x in enumerate(LABELS) if x[6]) + " END AS issue FROM part")
def label_rules(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame([(k, *x[:6]) for k, x in enumerate(LABELS)], "k int, label string, source_label string, description string, source_description string, confidence string, reason string")
    said = t.part.join(F.broadcast(rows), F.col("p_partkey") % len(LABELS) == F.col("k"))
    return said.select("p_partkey", label_issue(*(F.col(c) for c in rows.columns[1:])).alias("issue"))


REMEDIATION_FIELDS = "canonical_target_text,previous_target_sha256,source_sha256,unit_id"
#: Changes for each part, with what the database has: a duplicate, unknown units, hashes that differ, some done before.
CHANGES = """SELECT p_partkey AS change_id, CASE WHEN p_partkey % 17 = 3 THEN p_partkey - 1 WHEN p_partkey % 17 = 5 THEN -p_partkey ELSE p_partkey END AS unit_id,
 CASE WHEN p_partkey % 17 = 7 THEN 'unit_id' ELSE 'canonical_target_text,previous_target_sha256,source_sha256,unit_id' END AS fields,
 CASE WHEN p_partkey % 17 = 9 THEN 'x' ELSE SHA2_(p_name) END AS source_sha256, CASE WHEN p_partkey % 17 = 11 THEN '' ELSE UPPER(p_name) END AS canonical,
 CASE WHEN p_partkey % 17 IN (13, 14, 15) THEN SHA2_('old ' || p_name) ELSE SHA2_(p_type) END AS previous FROM part_rows"""
STORED = "SELECT p_partkey AS unit, SHA2_(p_name) AS source_hash, CASE WHEN p_partkey % 17 IN (14, 15) THEN SHA2_(UPPER(p_name)) ELSE SHA2_(p_type) END AS target_hash FROM part_rows"
DONE = "SELECT p_partkey AS unit, SHA2_('old ' || p_name) AS previous, SHA2_(UPPER(p_name)) AS now FROM part_rows WHERE p_partkey % 17 = 14"


@query(
    "v13_remediation_rules",
    f"WITH c AS ({CHANGES}), s AS ({STORED}), h AS ({DONE}), n AS (SELECT unit_id, COUNT(*) AS times FROM c GROUP BY 1) SELECT change_id, CASE WHEN fields <> '{REMEDIATION_FIELDS}' THEN 'invalid_fields' WHEN canonical = '' THEN 'empty_value' WHEN times > 1 THEN 'duplicate_unit' "
    "WHEN s.unit IS NULL THEN 'unknown_unit' WHEN s.source_hash <> c.source_sha256 THEN 'source_hash_mismatch' WHEN s.target_hash = c.previous THEN 'to_apply' WHEN s.target_hash <> SHA2_(canonical) THEN 'previous_hash_mismatch' "
    "WHEN h.unit IS NULL THEN 'no_history' ELSE 'applied_before' END AS outcome FROM c JOIN n USING (unit_id) LEFT JOIN s ON s.unit = c.unit_id LEFT JOIN h ON h.unit = c.unit_id AND h.previous = c.previous AND h.now = SHA2_(canonical)".replace("SHA2_(", "SHA256(").replace("SHA2_", "SHA256").replace("part_rows", "part"),
)
def remediation(t: Tables) -> DataFrame:
    """What becomes of each change of a manifest: the first rule it breaks, or whether it is still to do.

    Hashes hardly compress in memory though their table may in its file, so no side is broadcast by that size.
    """
    sql = lambda q: t.spark.sql(q.replace("SHA2_(", "sha2_256(").replace("part_rows", "{part}"), part=t.part)
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION sha2_256(x STRING) RETURNS STRING RETURN sha2(x, 256)")
    c, s, h = sql(CHANGES), sql(STORED), sql(DONE).select(F.col("unit").alias("done_unit"), F.col("previous").alias("done_previous"), "now")
    times = c.groupBy("unit_id").agg(F.count("*").alias("times"))
    now = F.sha2("canonical", 256)
    met = c.join(times.hint("merge"), "unit_id").join(s.hint("merge"), F.col("unit") == F.col("unit_id"), "left").join(h.hint("merge"), (F.col("done_unit") == F.col("unit_id")) & (F.col("done_previous") == F.col("previous")) & (F.col("now") == now), "left")
    outcome = first_issue({
        "invalid_fields": F.col("fields") != REMEDIATION_FIELDS,
        "empty_value": F.col("canonical") == "",
        "duplicate_unit": F.col("times") > 1,
        "unknown_unit": F.col("unit").isNull(),
        "source_hash_mismatch": F.col("source_hash") != F.col("source_sha256"),
        "to_apply": F.col("target_hash") == F.col("previous"),
        "previous_hash_mismatch": F.col("target_hash") != now,
        "no_history": F.col("done_unit").isNull(),
    })
    return met.select("change_id", F.coalesce(outcome, F.lit("applied_before")).alias("outcome"))


MODEL = "model-a"
USAGE = '"usage":{"input_tokens":10,"output_tokens":5,"total_tokens":15,"input_tokens_details":{"cached_tokens":4}}'


def response(text: str | None = '{\\"a\\":1}', *, head: str = f'"id":"r","model":"{MODEL}","status":"completed"', usage: str = USAGE, item: str = "") -> str:
    parts = "" if text is None else f'{{"type":"output_text","text":"{text}"}}'
    return f'{{{head},"output":[{{"type":"reasoning"}},{{"type":"message"{item},"content":[{parts}]}}],{usage}}}'


#: Responses as a service gives them, and what is wrong with each.
RESPONSES = [
    (response(), None), (response(head=f'"model":"{MODEL}","status":"completed"'), "no_id"), (response(head='"id":"r","status":"completed"'), "no_model"), (response(head='"id":"r","model":"other","status":"completed"'), "model_mismatch"),
    (response(head=f'"id":"r","model":"{MODEL}","status":"failed"'), "not_completed"), (f'{{"id":"r","model":"{MODEL}","status":"completed","output":"x",{USAGE}}}', "output_not_array"), (response(item=',"status":"in_progress"'), "message_not_completed"),
    (response(None), "not_one_text"), (response('x"},{"type":"output_text","text":"y'), "not_one_text"), (response('x"},{"type":"refusal","text":"y'), "other_content"), (response("{a"), "not_strict_json"), (response("[1]"), "not_an_object"),
    (response(usage='"usage":{"input_tokens":-1,"output_tokens":5,"total_tokens":4}'), "invalid_usage"), (response(usage='"usage":{"input_tokens":true,"output_tokens":5,"total_tokens":6}'), "invalid_usage"), (response(usage='"usage":{"input_tokens":1.5,"output_tokens":5,"total_tokens":6}'), "invalid_usage"),
    (response(usage='"usage":{"input_tokens":3,"output_tokens":5,"total_tokens":8,"input_tokens_details":{"cached_tokens":4}}'), "cached_over_input"), (response(usage='"usage":{"input_tokens":3,"output_tokens":5,"total_tokens":9}'), "total_mismatch"),
    (response(usage='"usage":{"input_tokens":3,"output_tokens":5,"total_tokens":8}'), None), ("not json", "not_an_object_response"), ("[]", "not_an_object_response"),
]


def transport_issue(raw: Column, model: str) -> Column:
    """The first rule that a service's response breaks, or null if it holds one strict JSON object."""
    v = F.try_parse_json(raw)
    kind = lambda x: F.schema_of_variant(x)
    text = lambda path: F.try_variant_get(v, path, "string")
    is_text = lambda path: F.coalesce(kind(F.try_variant_get(v, path, "variant")) == "STRING", F.lit(False)) & (F.coalesce(text(path), F.lit("")) != "")
    items = F.filter(F.coalesce(F.try_variant_get(v, "$.output", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.try_variant_get(x, "$.type", "string") == "message")
    open_ = F.exists(items, lambda x: F.coalesce(F.try_variant_get(x, "$.status", "string"), F.lit("completed")) != "completed")
    contents = F.flatten(F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, "$.content", "array<variant>"), F.array().cast("array<variant>"))))
    plain = lambda x: (F.try_variant_get(x, "$.type", "string") == "output_text") & F.coalesce(kind(F.try_variant_get(x, "$.text", "variant")) == "STRING", F.lit(False))
    said = F.try_parse_json(F.try_variant_get(F.get(contents, F.lit(0)), "$.text", "string"))

    def count(path: str, missing: int | None = None) -> tuple[Column, Column]:
        own = F.try_variant_get(v, path, "variant")
        n = F.try_variant_get(v, path, "long")
        fine = F.coalesce((kind(own) == "BIGINT") & (n >= 0), F.lit(False))
        return (fine, n) if missing is None else (fine | own.isNull(), F.coalesce(n, F.lit(missing)))

    (a, n_in), (b, n_out), (c, n_all), (d, cached) = count("$.usage.input_tokens"), count("$.usage.output_tokens"), count("$.usage.total_tokens"), count("$.usage.input_tokens_details.cached_tokens", 0)
    is_object = lambda x: F.coalesce(kind(x).startswith("OBJECT"), F.lit(False))
    return first_issue({
        "not_an_object_response": ~is_object(v),
        "no_id": ~is_text("$.id"),
        "no_model": ~is_text("$.model"),
        "model_mismatch": text("$.model") != model,
        "not_completed": F.coalesce(text("$.status"), F.lit("")) != "completed",
        "output_not_array": ~F.coalesce(kind(F.try_variant_get(v, "$.output", "variant")).startswith("ARRAY"), F.lit(False)),
        "message_not_completed": open_,
        "other_content": F.exists(contents, lambda x: ~F.coalesce(plain(x), F.lit(False))),
        "not_one_text": F.size(contents) != 1,
        "not_strict_json": said.isNull(),
        "not_an_object": ~is_object(said),
        "invalid_usage": ~(a & b & c & d),
        "cached_over_input": cached > n_in,
        "total_mismatch": n_all != n_in + n_out,
    })


@query("v14_transport_rules", f"SELECT event_id, CASE event_id % {len(RESPONSES)}" + "".join(f" WHEN {k} THEN '{x}'" for k, (_, x) in enumerate(RESPONSES) if x) + " END AS issue FROM events")
def transport_rules(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(RESPONSES)], "k int, raw string")
    said = t.events.join(F.broadcast(rows), F.col("event_id") % len(RESPONSES) == F.col("k"))
    return said.select("event_id", transport_issue(F.col("raw"), MODEL).alias("issue"))


def too_foreign(text: Column, tokens: Column, word: str, most: int) -> Column:
    """More than ``most`` words of a script after the protected tokens are taken out."""
    return F.regexp_count(without_tokens(text, tokens), F.lit(word)) > most
