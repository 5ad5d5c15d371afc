r"""Secret scan: corpus-wide ownership frequency of credential candidates.

Candidates are cut out of whole texts with one pattern a kind (leftmost, not
overlapping within a kind): assigned values, access key ids, long hexadecimal
words, provider keys and logins in addresses. Every candidate's value becomes a
SHA-256 hash, and for each hash the distinct owners and the distinct repositories
that hold it are counted over the whole corpus. The counts decide what a
candidate is:

* ``copied``: at EXAMPLE_OWNERS owners or EXAMPLE_REPOS repositories or more, as
  values of manuals, templates and copied pages are;
* ``dummy``: specific to its owner, but a placeholder by its looks (few
  different characters, only digits, a word such as "example");
* ``live``: specific to its owner and random by its looks.

Only DataFrame and SQL functions. A text is cut by ``(gap)(match)`` pieces, so
that positions are running sums of piece lengths; a text is scanned for a kind
only where a cheap test finds it possible. Texts are never shuffled and values
never written: what moves is one row a piece, with a hash. Owners are counted
from the distinct (hash, repository, owner), combined before the shuffle. A hash
with more than one HOT_SHARE-th of all candidates is joined by broadcast (there
are fewer than HOT_SHARE of them, whatever the corpus), the others by shuffle, so
a value in a third of all texts fills no task.

Positions are code points, ends exclusive. A null text is empty and has no
candidates. Rows with a null owner or repository count as one unknown owner or
repository. Repeated rows give repeated results, null keys are kept, an empty
table gives no row, other columns are ignored; a text of any length is handled
whole, its candidates are rows and not one array until its result is put together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, through_table

#: so many distinct owners, or repositories, make a value a copied example
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 5
#: a value of fewer different characters is a placeholder
MIN_DIFFERENT = 8
#: a hash of more than this share of the candidates is hot: fewer than HOT_SHARE can be
HOT_SHARE = 1000


@dataclass(frozen=True)
class Kind:
    """Pattern of a kind; ``group`` holds the secret value, of ``least`` characters or more."""
    name: str
    pattern: str
    possible: str      # a cheaper pattern, found wherever a match is
    group: int = 0
    least: int = 1


_QUOTE = r"[\x22\x27]?"
# The patterns of the contract (assign, access, hex), then of well-known key formats.
# Where a match ends only at a character outside its last class, the least length stands in the
# pattern (a shorter match would be dropped and hides no other); an assigned value may be followed
# by another key word, so its short matches are found and dropped.
KINDS = (
    Kind("assign", rf"((?i:password|passwd|secret|token|api_?key)){_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)",
         "(?i:password|passwd|secret|token|api_?key)", 2, 12),
    Kind("access", r"AKIA[A-Z0-9]{14}[A-Z0-9]*", "AKIA", 0, 18),
    Kind("hex", r"[0-9a-f]{16}[0-9a-f]*", "[0-9a-f]{16}", 0, 16),
    Kind("provider", r"gh[pousr]_[A-Za-z0-9]{36}[A-Za-z0-9]*|xox[abprs]-[A-Za-z0-9-]{20}[A-Za-z0-9-]*|AIza[A-Za-z0-9_-]{35}"
                     r"|sk_(?:live|test)_[A-Za-z0-9]{16}[A-Za-z0-9]*|eyJ[A-Za-z0-9_-]{1,1000}\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
                     r"|-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x0A\x0D]*",
         "gh[pousr]_|xox[abprs]-|AIza|sk_live_|sk_test_|eyJ|PRIVATE KEY", 0, 16),
    Kind("login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[A-Za-z0-9._%+-]{1,64}:([^\x00-\x20\x22\x27/@]{6,})@",
         "://[A-Za-z0-9._%+-]{1,64}:", 1, 6),
)
BASE = ("assign", "access", "hex")
PLACEHOLDER = r"(?i:example|sample|changeme|change_me|dummy|placeholder|your_|redacted|xxxx|\x2A\x2A\x2A\x2A|1234567|abcdefg)"

#: candidates of a row, as the operator returns them
SPAN = ("struct<kind:string, start:bigint, end:bigint, hash:string, owners:bigint, repositories:bigint, verdict:string>")


def _pieces(at: int, kind: Kind) -> str:
    """SQL array of a text's pieces of one kind: a gap and the match after it. The pattern
    ends a text too, so that the last gap is passed once; its piece has no match."""
    whole = rf"(?s)(.*?)({kind.pattern}|\z)"
    value = f"regexp_extract(x.m, r'{kind.pattern}', {kind.group})" if kind.group else "x.m"
    cut = (f"zip_with(regexp_extract_all(text, r'{whole}', 0), regexp_extract_all(text, r'{whole}', 2), "
           "(p, m) -> named_struct('piece', length(p), 'm', m))")
    return (f"CASE WHEN text rlike r'{kind.possible}' THEN filter(transform({cut}, (x, i) -> named_struct('kind', {at}, 'at', i, "
            f"'piece', x.piece, 'match', length(x.m), 'value', {value})), x -> x.match > 0) ELSE array() END")


def _found(kind: Kind) -> str:
    """The pieces with the value's hash and looks in the place of the value."""
    return (f"transform({kind.name}, x -> named_struct('kind', x.kind, 'at', x.at, 'piece', x.piece, 'match', x.match, "
            f"'valid', length(x.value) >= {kind.least}, 'hash', sha2(x.value, 256), 'random', "
            f"size(array_distinct(split(x.value, ''))) >= {MIN_DIFFERENT} AND NOT x.value rlike '^[0-9]+$' "
            f"AND NOT x.value rlike r'{PLACEHOLDER}'))")


def candidates(docs: DataFrame, key: str, text: str, repository: Column, owner: Column) -> DataFrame:
    """(row, key, repository, owner, pieces) of every row, written to the shared folder:
    ``row`` numbers the rows and is fixed by the written table."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
                       F.coalesce(owner.cast("string"), F.lit("")).alias("owner"))
    cut = rows.select("key", "repository", "owner", *(F.expr(_pieces(i, k)).alias(k.name) for i, k in enumerate(KINDS)))
    found = F.concat(*(F.expr(_found(k)) for k in KINDS))
    return through_table(cut.select(F.monotonically_increasing_id().alias("row"), "key", "repository", "owner",
                                    found.alias("pieces")), "candidates")


def spans_of(found: DataFrame) -> DataFrame:
    """(row, repository, owner, kind, start, end, hash, random): a row for every candidate."""
    pieces = found.select("row", "repository", "owner", F.explode("pieces").alias("x")).select(
        "row", "repository", "owner", "x.*")
    before = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = pieces.withColumn("end", F.sum(F.col("piece").cast("long")).over(before))
    return ends.where("valid").select("row", "repository", "owner", "kind", (F.col("end") - F.col("match")).alias("start"),
                                      "end", "hash", "random")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, places, owners, repositories): how many distinct owners and repositories hold a value."""
    held = spans.groupBy("hash", "repository", "owner").agg(F.count(F.lit(1)).alias("places"))
    by_owner = held.groupBy("hash", "owner").agg(F.sum("places").alias("places"), F.lit(0).alias("one")).groupBy("hash").agg(
        F.sum("places").alias("places"), F.count(F.lit(1)).alias("owners"))
    by_repository = held.groupBy("hash", "repository").agg(F.lit(0).alias("one")).groupBy("hash").agg(
        F.count(F.lit(1)).alias("repositories"))
    return by_owner.join(by_repository, "hash")


def judged(spans: DataFrame, owned: DataFrame, owners: int = EXAMPLE_OWNERS, repositories: int = EXAMPLE_REPOS) -> DataFrame:
    """Every candidate with its counts and verdict. Both arguments are tables."""
    n = spans.count()
    hot = owned.where(F.col("places") * HOT_SHARE > n)
    few = hot.select("hash", F.col("owners").alias("hot_owners"), F.col("repositories").alias("hot_repositories"))
    marked = spans.join(F.broadcast(few), "hash", "left")
    warm = marked.where("hot_owners IS NOT NULL").withColumnsRenamed({"hot_owners": "owners", "hot_repositories": "repositories"})
    cold = marked.where("hot_owners IS NULL").drop("hot_owners", "hot_repositories").join(
        owned.where(F.col("places") * HOT_SHARE <= n).drop("places").hint("merge"), "hash")
    verdict = F.when((F.col("owners") >= owners) | (F.col("repositories") >= repositories), "copied").when(
        F.col("random"), "live").otherwise("dummy")
    return warm.unionByName(cold).withColumn("verdict", verdict)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", repository: Column | None = None,
         owner: Column | None = None, example_owners: int = EXAMPLE_OWNERS,
         example_repositories: int = EXAMPLE_REPOS) -> DataFrame:
    """(key, found) of every row; found is an array of SPAN by start, then kind as in KINDS."""
    owner = F.col("source") if owner is None else owner
    found = candidates(docs, key, text, owner if repository is None else repository, owner)
    spans = through_table(spans_of(found), "secret_spans")
    owned = through_table(ownership(spans), "ownership")
    rows = judged(spans, owned, example_owners, example_repositories).groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("start", "kind", "end", "hash", "owners", "repositories", "verdict"))).alias("found"))
    names = "array(" + ", ".join(f"'{k.name}'" for k in KINDS) + ")"
    named = F.expr(f"transform(found, x -> named_struct('kind', {names}[x.kind], 'start', x.start, 'end', x.end, 'hash', x.hash, "
                   "'owners', x.owners, 'repositories', x.repositories, 'verdict', x.verdict))")
    return found.select("row", "key").join(rows.select("row", named.alias("found")), "row", "left").select(
        F.col("key").alias(key), F.coalesce("found", F.expr(f"cast(array() AS array<{SPAN}>)")).alias("found"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, hash and texts of the spans of :func:`scan`."""
    line = "concat(x.kind, ':', x.start, ':', x.end)"
    base = "x.kind IN ({})".format(", ".join(f"'{k}'" for k in BASE))
    count = lambda cond, name: F.expr(f"cast(size(filter(found, x -> {cond})) AS bigint)").alias(name)
    text = lambda cond: f"array_join(transform(filter(found, x -> {cond}), x -> {line}), ',')"
    return found.select(
        key, *(count(f"x.kind = '{k}'", f"n_{k}") for k in BASE), F.expr(f"sha2({text(base)}, 256)").alias("base_sha256"),
        F.expr(text("true")).alias("spans"), *(count(f"x.verdict = '{v}'", f"n_{v}") for v in ("live", "copied", "dummy")),
        F.expr(text("x.verdict = 'live'")).alias("live_spans"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no repositories: an owner's texts of one language count as one."""
    repository = F.concat_ws("/", "source", "lang")
    return digest(scan(documents(spark, sf_dir), repository=repository, owner=F.col("source")))


def _twin() -> str:
    """The same in DuckDB: pieces of every text and kind, running sums, counts by distinct owner."""
    kinds = []
    for i, k in enumerate(KINDS):
        whole = rf"(?s)(.*?)({k.pattern}|\z)"
        value = f"regexp_extract(m, '{k.pattern}', {k.group})" if k.group else "m"
        kinds.append(f"""
        SELECT rid, source, lang, {i} AS kind, nth, piece, m, {value} AS value, {k.least} AS least FROM (
            SELECT rid, source, lang, generate_subscripts(p, 1) AS nth, unnest([length(x) FOR x IN p]) AS piece, unnest(ms) AS m FROM (
                SELECT rid, source, lang, regexp_extract_all(text, '{whole}', 0) AS p, regexp_extract_all(text, '{whole}', 2) AS ms
                FROM docs WHERE regexp_matches(text, '{k.possible}'))) WHERE m <> ''""")
    names = "[" + ", ".join(f"'{k.name}'" for k in KINDS) + "]"
    line = f"({names})[kind + 1] || ':' || start || ':' || stop"
    in_base = f"kind < {len(BASE)}"
    joined = lambda cond: f"coalesce(string_agg({line}, ',' ORDER BY start, kind) FILTER (WHERE {cond}), '')"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source,
                         concat_ws('/', source, lang) AS lang FROM documents),
    pieces AS ({' UNION ALL '.join(kinds)}),
    placed AS (SELECT *, sum(piece) OVER (PARTITION BY rid, kind ORDER BY nth) AS stop FROM pieces),
    spans AS (SELECT rid, source, lang, kind, cast(stop - length(m) AS BIGINT) AS start, cast(stop AS BIGINT) AS stop, sha256(value) AS hash,
                     len(list_distinct(string_split(value, ''))) >= {MIN_DIFFERENT} AND NOT regexp_full_match(value, '[0-9]+')
                     AND NOT regexp_matches(value, '{PLACEHOLDER}') AS random
              FROM placed WHERE length(value) >= least),
    owned AS (SELECT hash, count(DISTINCT source) >= {EXAMPLE_OWNERS} OR count(DISTINCT lang) >= {EXAMPLE_REPOS} AS copied
              FROM spans GROUP BY hash),
    judged AS (SELECT spans.*, CASE WHEN copied THEN 'copied' WHEN random THEN 'live' ELSE 'dummy' END AS verdict
               FROM spans JOIN owned USING (hash))
    SELECT any_value(doc_id) AS doc_id, {', '.join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(BASE))},
           sha256({joined(in_base)}) AS base_sha256, {joined('kind >= 0')} AS spans,
           {', '.join(f"count(*) FILTER (WHERE verdict = '{v}') AS n_{v}" for v in ('live', 'copied', 'dummy'))},
           {joined("verdict = 'live'")} AS live_spans
    FROM docs LEFT JOIN judged USING (rid) GROUP BY docs.rid"""


OP11_SQL = _twin()
