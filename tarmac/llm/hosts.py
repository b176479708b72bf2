"""URL filters: rules by host and path, and the reputation of hosts where no rule fits.

Pages with a known outcome (1 bad, 0 good) are counted by host, registered domain and suffix. Rates are
shrunk level by level with beta-binomial priors: the suffix towards all pages, the domain towards its
suffix, the host towards its domain. How strongly is estimated from the counts (intra-class correlation).
A host is blocked if the lower bound of its posterior rate is above a limit. Pages are reduced to
counts per host before anything is joined; a hot host is one row per task.

The suffix is the last label, or the last two where `SUFFIXES` lists them (registries that sell names below a second
label, and providers whose customers each have a name of their own); the domain has one label more. The table is short: other such
suffixes count as domains unless they are given.

A null url, or one without `://`, has empty host and path; the empty host is a host like any other.
Without outcomes every host has the prior's rate 0.5 and is allowed. Equal rows get equal verdicts, an
empty table gives no rows. Extra columns are kept; columns named like an added one are replaced.
"""

from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, unpacked

#: (host, path, verdict): for a host with its subdomains and paths that begin so.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
LIMIT = 0.5
#: Standard deviations below the mean: 95 % of the posterior are above the bound.
BELOW = 1.645
#: Bounds and default of a prior's strength, in pages.
STRENGTH = (1.0, 1000.0, 10.0)

# Public suffixes of two labels.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "org.uk", "plc.uk", "sch.uk", "com.au", "edu.au", "gov.au", "net.au", "org.au",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "ac.nz", "co.nz", "net.nz", "org.nz", "co.za", "org.za", "com.br", "net.br",
    "org.br", "com.cn", "net.cn", "org.cn", "com.hk", "com.mx", "com.sg", "com.tr", "com.tw", "com.ar", "com.co", "com.my", "com.ph",
    "com.ua", "ac.in", "co.in", "net.in", "org.in", "co.id", "co.il", "co.kr", "or.kr", "co.th", "blogspot.com", "github.io", "gitlab.io",
    "herokuapp.com", "appspot.com", "netlify.app", "pages.dev", "vercel.app", "web.app", "workers.dev")

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LEVELS = ("suffix", "domain", "host")


def host(url):
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def matched_rule(host_, path_, rules):
    """The longest rule that fits, as struct (size, rule, verdict), or null."""
    each = F.array(*[F.struct(
        F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"),
        F.lit(h).alias("host"), F.lit("." + h).alias("below"), F.lit(p).alias("path"))
        for h, p, v in rules])
    return F.array_max(F.filter(each, lambda r: (
        (host_ == r["host"]) | F.endswith(host_, r["below"])) & F.startswith(path_, r["path"])))


def judged_by_rules(pages, rules=RULES, url="url"):
    """Pages with `host`, `path`, `rule` and the rule's `verdict`."""
    df = pages.select(packed(pages), host(column(url)).alias("host"), path(column(url)).alias("path"))
    found = matched_rule(F.col("host"), F.col("path"), rules) if rules else F.lit(None)
    df = df.withColumn("found", found) if rules else df
    rule, verdict = ((F.col("found.rule"), F.col("found.verdict")) if rules
                     else (F.lit(None).cast("string"),) * 2)
    return unpacked(df.select("row", "host", "path", rule.alias("rule"), verdict.alias("verdict")),
                    pages.columns, added=["host", "path", "rule", "verdict"])


def levels(df, suffixes=SUFFIXES):
    """`df` with the `suffix` and `domain` of its `host`. A number is its own domain and has no suffix."""
    name = F.regexp_replace("host", ":[0-9]*$", "")
    number = name.rlike(r"^[0-9.]+$")
    two = F.substring_index(name, ".", -2)
    long = two.isin(*suffixes) if suffixes else F.lit(False)
    return df.withColumns({
        "suffix": F.when(number, "").when(long, two).otherwise(F.substring_index(name, ".", -1)),
        "domain": F.when(number, name).when(long, F.substring_index(name, ".", -3)).otherwise(two)})


def _strength(counts):
    """One row: strength of the prior by the spread of rates between the groups of a level."""
    n, bad = F.col("n"), F.col("bad")
    sums = counts.agg(
        F.count("*").alias("k"), F.coalesce(F.sum(n), F.lit(0)).alias("total"),
        F.sum(bad).alias("bad"), F.sum(bad * bad / n).alias("squares"),
        F.sum(n * n).alias("sizes"))
    mean = F.col("bad") / F.col("total")
    between = (F.col("squares") - F.col("total") * mean * mean) / (F.col("k") - 1)
    within = (F.col("bad") - F.col("squares")) / (F.col("total") - F.col("k"))
    size = (F.col("total") - F.col("sizes") / F.col("total")) / (F.col("k") - 1)
    rho = (F.col("between") - F.col("within")) / (
        F.col("between") + (F.col("size") - 1) * F.col("within"))
    low, high, usual = STRENGTH
    enough = (F.col("k") > 1) & (F.col("total") > F.col("k"))
    return sums.select(
        "k", "total", F.when(enough, between).alias("between"),
        F.when(enough, within).alias("within"), F.when(enough, size).alias("size")).select(
        F.when(F.col("between").isNull(), usual).when(rho <= 0, high)
        .when(rho >= 1, low).otherwise(F.least(F.greatest((1 - rho) / rho, F.lit(low)), F.lit(high)))
        .alias("strength"))


def reputations(outcomes, hosts):
    """`hosts` with posterior `rate` and its lower `bound`.

    outcomes: (host, bad) of labelled pages; hosts: distinct hosts to be judged.
    """
    seen = levels(outcomes.groupBy("host").agg(F.count("*").cast("double").alias("n"),
                                                F.sum("bad").cast("double").alias("bad")))
    every = seen.agg(((F.coalesce(F.sum("bad"), F.lit(0.0)) + 1)
                      / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2)).alias("above")).first()["above"]
    df = levels(hosts).withColumn("rate", F.lit(every))
    for level in _LEVELS:
        counts = seen.groupBy(F.col(level).alias("group")).agg(
            F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        strength = _strength(counts).first()["strength"]
        n, bad = F.coalesce("n", F.lit(0.0)), F.coalesce("bad", F.lit(0.0))
        df = df.join(counts, F.col(level) == F.col("group"), "left").select(
            "host", "domain", "suffix", ((strength * F.col("rate") + bad) / (strength + n)).alias("rate"),
            (strength + n).alias("weight"))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return df.select("host", "rate", (F.col("rate") - BELOW * spread).alias("bound"))


def judge(pages, rules=RULES, outcomes=None, limit=LIMIT, url="url"):
    """Pages with `host`, `path`, `rule` and `verdict`: the rule's, else the host's.

    outcomes: (host, bad) of labelled pages; by default the pages that rules decide are the labelled ones.
    """
    df = judged_by_rules(pages, rules, url)
    if outcomes is None:
        outcomes = df.where(F.col("verdict").isNotNull()).select(
            "host", (F.col("verdict") == "block").cast("int").alias("bad"))
    hosts = df.where(F.col("verdict").isNull()).select("host").distinct()
    known = reputations(outcomes, hosts).select(
        F.col("host").alias("known"),
        F.when(F.col("bound") > limit, "block").otherwise("allow").alias("by_host"))
    rows = df.select(packed(df), "host", F.col("verdict").alias("by_rule"))
    # Pages that a rule decides have no partner. Each gets a key that no host is, so that they spread over all tasks.
    key = F.when(F.col("by_rule").isNull(), F.col("host")).otherwise(
        F.concat(F.lit("/"), F.monotonically_increasing_id().cast("string")))
    joined = rows.withColumn("key", key).join(known, F.col("key") == F.col("known"), "left")
    return unpacked(joined.withColumn("verdict", F.coalesce("by_rule", "by_host")), df.columns,
                    added=["verdict"])


def allowed(pages, rules=RULES, outcomes=None, limit=LIMIT):
    """The pages that stay, with their own columns."""
    df = judge(pages, rules, outcomes, limit)
    return df.where(F.col("verdict") == "allow").select(*[column(c) for c in pages.columns])


def digest(judged):
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
_SUFFIX_SQL = ", ".join(f"'{s}'" for s in SUFFIXES)
_LOW, _HIGH, _USUAL = STRENGTH


def _level_sql(level, above):
    return f"""
counts_{level} AS (SELECT {level} AS g, sum(n) AS n, sum(bad) AS bad FROM seen GROUP BY 1),
sums_{level} AS (
  SELECT count(*) AS k, sum(n) AS total, sum(bad) AS bad, sum(bad * bad / n) AS squares,
         sum(n * n) AS sizes FROM counts_{level}),
parts_{level} AS (
  SELECT (squares - bad * bad / total) / (k - 1) AS msb, (bad - squares) / (total - k) AS msw,
         (total - sizes / total) / (k - 1) AS n0 FROM sums_{level} WHERE k > 1 AND total > k),
rho_{level} AS (SELECT (msb - msw) / (msb + (n0 - 1) * msw) AS rho FROM parts_{level}),
strength_{level} AS (
  SELECT coalesce((SELECT CASE WHEN rho <= 0 THEN {_HIGH} WHEN rho >= 1 THEN {_LOW}
                   ELSE least(greatest((1 - rho) / rho, {_LOW}), {_HIGH}) END FROM rho_{level}),
                  {_USUAL}) AS m),
rate_{level} AS (
  SELECT h.host, h.domain, h.suffix, m + coalesce(c.n, 0) AS weight,
         (m * h.rate + coalesce(c.bad, 0)) / (m + coalesce(c.n, 0)) AS rate
  FROM {above} h CROSS JOIN strength_{level} LEFT JOIN counts_{level} c ON h.{level} = c.g)"""


def _levels_sql(rows):
    return f"""
  SELECT *, CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
                 WHEN two IN ({_SUFFIX_SQL}) THEN array_to_string(string_split(name, '.')[-3:], '.') ELSE two END AS domain,
         CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN '' WHEN two IN ({_SUFFIX_SQL}) THEN two
              ELSE string_split(name, '.')[-1] END AS suffix
  FROM (SELECT *, array_to_string(string_split(name, '.')[-2:], '.') AS two
        FROM (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM {rows}))"""


ORACLE_SQL = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
parsed AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
fits AS (
  SELECT r, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY r ORDER BY len(rule_host || rule_path) DESC) AS k
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                        AND starts_with(path, rule_path)),
ruled AS (
  SELECT p.*, rule, rule_verdict FROM parsed p LEFT JOIN fits f ON p.r = f.r AND f.k = 1),
counted AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (rule_verdict = 'block') AS DOUBLE) AS bad
  FROM ruled WHERE rule_verdict IS NOT NULL GROUP BY 1),
seen AS ({_levels_sql('counted')}),
open AS (SELECT DISTINCT host FROM ruled WHERE rule_verdict IS NULL),
start AS (
  SELECT *, (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM seen) AS rate
  FROM ({_levels_sql('open')})),
{_level_sql('suffix', 'start')},
{_level_sql('domain', 'rate_suffix')},
{_level_sql('host', 'rate_domain')}
SELECT page_id, ruled.host, path, rule,
       coalesce(rule_verdict, CASE WHEN rate - {BELOW} * sqrt(rate * (1 - rate) / (weight + 1)) > {LIMIT}
                                   THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN rate_host ON ruled.host = rate_host.host
"""
