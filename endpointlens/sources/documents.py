"""Rules for nested JSON documents, checked for all documents of a table at once.

A document is parsed as a variant, so a value of the wrong type stays what it is and is reported, not lost as a null.
Every object of a level - the document, each entry of a list in it - is a map of variants; the level's rules are one
expression on that map. Errors are rows (file, path, field, error), the path with the place in each list.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJECT, LIST = "map<string,variant>", "array<variant>"


@dataclass(frozen=True)
class Rule:
    """A field's kind: text, whole, number, texts (some texts), counts (text to whole) or objects."""

    name: str
    kind: str = "text"
    required: bool = False


@dataclass(frozen=True)
class Level:
    """Rules of one kind of object; `lists` are the fields that hold objects of another level."""

    name: str
    rules: tuple[Rule, ...]
    lists: dict[str, "Level"] = field(default_factory=dict)
    #: (field, condition on the value's map, text): rules between fields
    between: tuple = ()


def value(m: Column, name: str) -> Column:
    return F.try_element_at(m, F.lit(name))


def text_of(m: Column, name: str) -> Column:
    """The text of a field, null if it isn't one."""
    v = value(m, name)
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def texts_of(m: Column, name: str) -> Column:
    """The texts of a list field; none if it isn't a list."""
    items = F.coalesce(F.try_variant_get(value(m, name), "$", LIST), F.array().cast(LIST))
    return F.transform(items, lambda x: F.try_variant_get(x, "$", "string"))


def fits(v: Column, kind: str, required: bool) -> Column:
    """Whether a value that is there is of the kind; required ones must hold something."""
    named = F.schema_of_variant(v)
    whole = lambda k: k.isin("BIGINT", "BOOLEAN")  # noqa: E731  a truth value counts as a number
    if kind == "text":
        return (named == "STRING") & (F.try_variant_get(v, "$", "string") != "")
    if kind == "whole":
        return whole(named)
    if kind == "number":
        return whole(named) | named.isin("DOUBLE", "FLOAT") | named.startswith("DECIMAL")
    if kind == "counts":
        m = F.try_variant_get(v, "$", OBJECT)
        return named.startswith("OBJECT") & F.forall(F.map_values(m), lambda x: whole(F.schema_of_variant(x))) & ((F.size(m) > 0) | F.lit(not required))
    items = F.try_variant_get(v, "$", LIST)
    of = (lambda x: F.schema_of_variant(x) == "STRING") if kind == "texts" else (lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    full = (F.size(items) > 0) if kind == "texts" and required else F.lit(True)
    return named.startswith("ARRAY") & F.forall(items, of) & full


#: Fixed words of the error texts.
NAMES = {"text": "string", "whole": "integer", "number": "numeric", "texts": "list", "counts": "map", "objects": "list"}


def broken(m: Column, rule: Rule) -> Column:
    """The error of a rule, or null. Optional texts and numbers may be null, other optional fields only absent."""
    v = value(m, rule.name)
    there = v.isNotNull() & (~F.is_variant_null(v) if rule.kind in ("text", "number") else F.lit(True))
    ok = F.coalesce(fits(v, rule.kind, rule.required), F.lit(False))
    if rule.required:
        return F.when(~(there & ok), f"missing or invalid {NAMES[rule.kind]} field")
    return F.when(there & ~ok, f"invalid {NAMES[rule.kind]} field")


def problems(m: Column, level: Level, strict: bool) -> Column:
    """The errors (field, error) of an object of a level, as an array."""
    error = lambda name, text: F.when(text.isNotNull(), F.struct(F.lit(name).alias("field"), text.alias("error")))
    checks = [error(r.name, broken(m, r)) for r in level.rules]
    checks += [error(name, F.when(F.coalesce(bad(m), F.lit(False)), text)) for name, bad, text in level.between]
    if strict:
        extra = F.array_sort(F.array_except(F.map_keys(m), F.array(*[F.lit(r.name) for r in level.rules])))
        checks.append(error("", F.when(F.size(extra) > 0, F.concat(F.lit("unsupported fields: "), F.array_join(extra, ", ")))))
    none = F.array(F.struct(F.lit("").alias("field"), F.lit("must be a JSON object").alias("error")))
    return F.when(m.isNull(), none).otherwise(F.array_compact(F.array(*checks)))


def found(rows: DataFrame, whole: Column) -> DataFrame:
    """(file, path, field, error) of rows (file, path, m) and the errors of each."""
    return rows.select("file", "path", F.explode(whole).alias("e")).select("file", "path", "e.*")


def dealt(raw: DataFrame) -> DataFrame:
    """Documents (file, value) over all tasks: a small file of them is much work, and its reader would leave it to one task."""
    spark = raw.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return raw.select("file", "value").repartition(n, "file")


def objects(raw: DataFrame) -> DataFrame:
    """(file, path, m) of documents (file, value); m is null where the text is no JSON object."""
    v = F.try_parse_json("value")
    return raw.select("file", F.lit("").alias("path"), F.when(F.schema_of_variant(v).startswith("OBJECT"), F.try_variant_get(v, "$", OBJECT)).alias("m"))


def entries(rows: DataFrame, name: str) -> DataFrame:
    """(file, path, position, above, m) of the entries of a list field."""
    items = F.try_variant_get(value(F.col("m"), name), "$", LIST)
    each = rows.select("file", F.col("path").alias("_above"), F.col("m").alias("above"), F.posexplode(items).alias("position", "v"))
    dot = F.when(F.col("_above") != "", F.concat("_above", F.lit("."))).otherwise(F.lit(""))
    path = F.concat(dot, F.lit(f"{name}["), F.col("position").cast("string"), F.lit("]"))
    m = F.when(F.schema_of_variant("v").startswith("OBJECT"), F.try_variant_get("v", "$", OBJECT))
    return each.select("file", path.alias("path"), "position", "above", m.alias("m"))


def errors(rows: DataFrame, level: Level, strict: bool = True) -> DataFrame:
    """All errors of a level and of the levels below it."""
    out = found(rows, problems(F.col("m"), level, strict))
    for name, below in level.lists.items():
        out = out.unionByName(errors(entries(rows, name), below, strict))
    return out


#: Kinds, modes and their other names.
KINDS = ("positive_exact", "positive_consensus", "negative_generated")
MODES = ("exact_rrset", "consensus_match", "nxdomain")
ALIASES = {"baseline_match": "consensus_match"}


def mode_of(m: Column) -> Column:
    given = text_of(m, "expected_mode")
    out = given
    for alias, mode in ALIASES.items():
        out = F.when(given == alias, mode).otherwise(out)
    return out


def _empty(m: Column, name: str) -> Column:
    return F.coalesce(text_of(m, name), F.lit("")) == ""


PROBE = Level(
    "probe",
    (
        Rule("id", required=True), Rule("kind", required=True), Rule("qtype", required=True), Rule("expected_mode", required=True), Rule("qname"), Rule("qname_template"),
        Rule("expected_answers", "texts"), Rule("expected_nameservers", "texts"), Rule("parent_zone"), Rule("source"), Rule("stability_score", "number"), Rule("notes"),
    ),
    between=(
        ("qname", lambda m: _empty(m, "qname") & _empty(m, "qname_template"), "either 'qname' or 'qname_template' is needed"),
        ("kind", lambda m: ~text_of(m, "kind").isin(*KINDS), "unsupported probe kind"),
        ("expected_mode", lambda m: ~mode_of(m).isin(*MODES), "unsupported expected_mode"),
        ("qname_template", lambda m: (text_of(m, "kind") == "negative_generated") & _empty(m, "qname_template"), "negative_generated probes need 'qname_template'"),
        ("expected_answers", lambda m: (mode_of(m) == "exact_rrset") & (F.size(texts_of(m, "expected_answers")) == 0), "exact_rrset probes need 'expected_answers'"),
    ),
)


def corpus_level(version: int | None = None, second: bool = True) -> Level:
    """The corpus document; from version 2 on it names its generator, sources and counts."""
    between = []
    if version is not None:
        between.append(("schema_version", lambda m: F.try_variant_get(value(m, "schema_version"), "$", "int") != version, f"unsupported schema_version; expected {version}"))
    rules = (
        Rule("schema_version", "whole", True), Rule("corpus_version", required=True), Rule("generated_at", required=True), Rule("generator_version", required=second),
        Rule("sources_used", "texts", second), Rule("probe_counts", "counts", second), Rule("probes", "objects", True),
    )
    return Level("corpus", rules, {"probes": PROBE}, tuple(between))


_HOST = (Rule("hostname", required=True), Rule("ipv4", "texts"), Rule("ipv6", "texts"), Rule("source", required=True), Rule("operator_family"), Rule("notes"))
HOST = Level("host", _HOST)
DELEGATION = Level(
    "delegation", (Rule("zone", required=True), Rule("nameservers", "texts", True), Rule("exact_hosts", "objects", True), Rule("source", required=True), Rule("notes")), {"exact_hosts": HOST}
)
SEEDS = Level(
    "seeds",
    (Rule("snapshot_version", "whole", True), Rule("generated_at", required=True), Rule("sources_used", "texts", True), Rule("root_servers", "objects", True), Rule("delegations", "objects", True)),
    {"root_servers": HOST, "delegations": DELEGATION},
)


def corpus_errors(raw: DataFrame, version: int | None = None, strict: bool = True) -> DataFrame:
    """Errors of corpus documents (file, value), by the rules of their own version; a document's own rules and those of its probes are a pass each."""
    rows, m = objects(dealt(raw)), F.col("m")
    second = F.coalesce(F.try_variant_get(value(m, "schema_version"), "$", "int"), F.lit(0)) >= 2
    whole = F.when(second, problems(m, corpus_level(version, True), strict)).otherwise(problems(m, corpus_level(version, False), strict))
    return found(rows, whole).unionByName(errors(entries(rows, "probes"), PROBE, strict))


def seed_errors(raw: DataFrame) -> DataFrame:
    """Errors of seed documents (file, value); further fields are allowed."""
    return errors(objects(dealt(raw)), SEEDS, strict=False)


def corpus_probes(raw: DataFrame) -> DataFrame:
    """(file, position, ...) of all probes of corpus documents, other names of a mode replaced; a wrong type is a null."""
    m = F.col("m")
    texts = [text_of(m, c).alias(c) for c in ("id", "kind", "qname", "qname_template", "qtype", "parent_zone", "source", "notes")]
    lists = [texts_of(m, c).alias(c) for c in ("expected_answers", "expected_nameservers")]
    score = F.try_variant_get(value(m, "stability_score"), "$", "double").alias("stability_score")
    return entries(objects(raw), "probes").where(m.isNotNull()).select("file", "position", *texts, mode_of(m).alias("expected_mode"), *lists, score)
