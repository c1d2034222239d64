"""Check SQL for the registered queries, for an engine with RE2 patterns and list functions."""

from __future__ import annotations

from postweave.catalog import inputs as I
from postweave.catalog import payloads as L
from postweave.catalog import queries as Q
from postweave.functions import extract as X
from postweave.functions import rules as R
from postweave.operators import metrics as M
from postweave.operators import parse as P
from postweave.sources import grid as G
from postweave.sources import html as H

ORACLES: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def ctes(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in parts.items()) + "\n"


POSTINGS, JOBS, STATUS_LOG, RECORDS = (I.plain(s) for s in (I.POSTINGS, I.JOBS, I.STATUS_LOG, I.RECORDS))


# ── extraction ──────────────────────────────────────────────────────────────────────────────────

def first_match(t: str, patterns, flags: str = "(?im)") -> str:
    cases = " ".join(f"WHEN regexp_matches({t}, {q(flags + p)}) THEN {strip(f'regexp_extract({t}, {q(flags + p)}, 1)')}" for p in patterns)
    return f"CASE {cases} END"


def location(t: str) -> str:
    def found(p: str) -> str:
        return strip(f"regexp_extract({t}, {q('(?im)' + p)}, 1)")

    return "CASE " + " ".join(f"WHEN length({found(p)}) BETWEEN 3 AND 99 THEN {found(p)}" for p in X.LOCATION_PATTERNS) + " END"


def employment(t: str) -> str:
    return f"lower({first_match(t, X.EMPLOYMENT_PATTERNS, '(?i)')})"


def remote(t: str) -> str:
    return f"(contains(lower({t}), 'remote') OR contains(lower({t}), 'hybrid'))"


def skills(t: str) -> str:
    names = ", ".join(q(s) for s in X.SKILLS)
    return f"array_to_string(list_filter([{names}], lambda s: contains(lower({t}), lower(s))), '|')"


def amount(s: str) -> str:
    n = f"TRY_CAST(replace(rtrim(lower({s}), 'k'), ',', '') AS BIGINT)"
    v = f"CASE WHEN lower({s}) LIKE '%k' THEN {n} * 1000 WHEN {n} >= {X.SALARY_FLOOR} THEN {n} END"
    return f"CASE WHEN ({v}) > 0 AND ({v}) < {X.SALARY_CEILING} THEN ({v}) END"


def salaries(source: str, key: str, t: str) -> dict[str, str]:
    """CTEs; the last, named pay, has one row per key that has a salary."""
    def hits(i: int, p: str) -> str:
        p = q("(?i)" + p)
        return (
            f"SELECT {key} AS k, {i} AS p, generate_subscripts(regexp_extract_all({t}, {p}, 1), 1) AS i, "
            f"unnest(regexp_extract_all({t}, {p}, 1)) AS a, unnest(regexp_extract_all({t}, {p}, 2)) AS b FROM {source}"
        )

    return {
        "hits": " UNION ALL ".join(hits(i, p) for i, p in enumerate(X.SALARY_PATTERNS)),
        "sums": f"SELECT k, p, i, {amount('a')} AS a, {amount('b')} AS b FROM hits",
        "pay": "SELECT k, CAST(least(a, b) AS INT) AS lo, CAST(greatest(a, b) AS INT) AS hi FROM sums WHERE a IS NOT NULL AND b IS NOT NULL "
               "QUALIFY row_number() OVER (PARTITION BY k ORDER BY p, i) = 1",
    }


def description(t: str, cut: bool = True) -> str:
    lines = f"list_transform(string_split({t}, chr(10)), lambda x: {strip('x')})"
    header = q("^(?i:" + "|".join(X.DESCRIPTION_HEADERS) + r")[:\s]")
    at = f"list_position(list_transform({lines}, lambda x: regexp_matches(x, {header})), true)"
    kept = f"list_filter(list_slice({lines}, {at}, len({lines})), lambda x: x <> '')"
    body, head = (f"list_slice({kept}, 1, 100)", f"left({t}, 2000)") if cut else (kept, t)
    return f"CASE WHEN coalesce({at}, 0) > 0 THEN array_to_string({body}, chr(10)) ELSE {head} END"


def fp(t: str) -> str:
    head = f"lower(array_to_string(list_slice(string_split({strip(t)}, chr(10)), 1, 2), ' '))"
    return f"md5(trim(regexp_replace(regexp_replace({head}, {q(X.FINGERPRINT_NOISE)}, ' ', 'g'), '\\s+', ' ', 'g')))"


def of_text(name: str, expression: str, alias: str) -> None:
    ORACLES[name] = ctes(postings=POSTINGS) + f"SELECT id, {expression} AS {alias} FROM postings"


T = "raw_text"
of_text("extract_title", first_match(T, X.TITLE_PATTERNS), "title")
of_text("extract_company", first_match(T, X.COMPANY_PATTERNS), "company")
of_text("extract_location", location(T), "location")
of_text("extract_skills", skills(T), "skills")
of_text("extract_names_one_pass", skills(T), "skills")
of_text("extract_employment_type", employment(T), "employment_type")
of_text("is_remote", remote(T), "remote")
of_text("clean_description_of_postings", description(T), "description")
of_text("fingerprint_of_postings", fp(T), "fp")



def whole_word(name: str) -> str:
    special = "".join("\\" + c if c in "+.#/" else c for c in name.lower())
    return rf"CASE WHEN regexp_matches(lower(raw_text), '(^|[^\pL\pN]){special}($|[^\pL\pN])') THEN {q(name)} END"


ORACLES["extract_whole_word_skills"] = ctes(postings=POSTINGS) + (
    f"SELECT id, array_to_string(list_filter([{', '.join(map(whole_word, X.SKILLS))}], lambda s: s IS NOT NULL), '|') AS skills FROM postings"
)
ORACLES["extract_salary"] = ctes(postings=POSTINGS, **salaries("postings", "id", T)) + (
    "SELECT id, lo AS salary_min, hi AS salary_max, CASE WHEN lo IS NOT NULL THEN 'USD' END AS currency, "
    "CASE WHEN lo IS NOT NULL THEN 'yearly' END AS period FROM postings LEFT JOIN pay ON id = k"
)
ORACLES["extract_from_documents"] = ctes(**salaries("documents", "doc_id", "text")) + (
    f"SELECT doc_id, {first_match('text', X.TITLE_PATTERNS)} AS title, {first_match('text', X.COMPANY_PATTERNS)} AS company, "
    f"{location('text')} AS location, lo AS salary_min, hi AS salary_max, {skills('text')} AS skills, "
    f"{employment('text')} AS employment_type, {remote('text')} AS remote FROM documents LEFT JOIN pay ON doc_id = k"
)
ORACLES["clean_description"] = f"SELECT doc_id, {description('text')} AS description FROM documents"
ORACLES["clean_description_uncut"] = f"SELECT doc_id, {description('text', cut=False)} AS description FROM documents"
ORACLES["fingerprint"] = f"SELECT doc_id, {fp('text')} AS fp FROM documents"

# Fields of every posting by text and, with m_ columns, by board metadata; then the rows of both parsers.
_FIELDS = dict(
    postings=POSTINGS, **salaries("postings", "id", T),
    fields=(
        f"SELECT p.*, {first_match(T, X.TITLE_PATTERNS)} AS title, {first_match(T, X.COMPANY_PATTERNS)} AS company, "
        f"{location(T)} AS place_found, {remote(T)} AS far, lo, hi, {skills(T)} AS skills, {employment(T)} AS emp, "
        f"{description(T)} AS description FROM postings p LEFT JOIN pay ON id = k"
    ),
    generic=(
        "SELECT id AS raw_id, coalesce(nullif(title, ''), '[UNKNOWN]') AS job_title, company, place_found AS location, far AS remote, "
        "lo AS salary_min, hi AS salary_max, CASE WHEN lo IS NOT NULL THEN 'USD' END AS salary_currency, skills, emp AS employment_type, "
        "description AS description_clean, CASE WHEN coalesce(title, '') = '' THEN 0.3 ELSE 0.5 END::DOUBLE AS confidence, "
        "'structured_parser' AS model_used, array_to_string(list_filter([CASE WHEN coalesce(title, '') = '' THEN "
        f"{q(P.NO_TITLE)} END, CASE WHEN coalesce(company, '') = '' THEN {q(P.NO_COMPANY)} END], lambda x: x IS NOT NULL), '|') AS warnings "
        "FROM fields"
    ),
    board=(
        "SELECT id AS raw_id, coalesce(nullif(m_title, ''), title, '[PARSE FAILED]') AS job_title, coalesce(m_company, company) AS company, "
        "coalesce(nullif(concat_ws(', ', nullif(m_city, ''), m_country), ''), place_found) AS location, coalesce(m_workplace = 'remote', false) AS remote, "
        "lo AS salary_min, hi AS salary_max, CASE WHEN lo IS NOT NULL THEN 'USD' END AS salary_currency, skills, coalesce(m_employment, emp) AS employment_type, "
        "description AS description_clean, CASE WHEN coalesce(nullif(m_title, ''), title) IS NULL THEN 0.0 ELSE 0.7 END::DOUBLE AS confidence, "
        "'structured_parser' AS model_used, CASE WHEN coalesce(nullif(m_title, ''), title) IS NULL THEN 'Batch parse error: no job title' "
        f"WHEN NOT coalesce(m_workplace = 'remote', false) THEN {q(P.BY_RULES)} ELSE '' END AS warnings FROM fields"
    ),
    structured=(
        "SELECT b.* FROM board b JOIN postings p ON p.id = b.raw_id WHERE source = 'workable' UNION ALL "
        "SELECT g.* FROM generic g JOIN postings p ON p.id = g.raw_id WHERE source <> 'workable'"
    ),
)
ORACLES["parse_generic"] = ctes(**_FIELDS) + "SELECT * FROM generic"
ORACLES["parse_workable"] = ctes(**_FIELDS) + "SELECT * FROM board"
ORACLES["parse_structured"] = ctes(**_FIELDS) + "SELECT * FROM structured"


def prompt(t: str, cut: bool = True) -> str:
    return f"replace({q(P.PROMPT)}, '{{raw_text}}', {f'left({t}, 8000)' if cut else t})"


ORACLES["build_prompt_uncut"] = (
    f"SELECT doc_id, CAST(length({prompt('text', False)}) AS INT) AS chars, md5({prompt('text', False)}) AS digest FROM documents"
)
ORACLES["build_prompt"] = f"SELECT doc_id, CAST(length({prompt('text')}) AS INT) AS chars, md5({prompt('text')}) AS digest FROM documents"


# What the answers say, read from the columns they were made of.
_ANSWERS = (
    "SELECT id AS raw_id, seq, seq % 10 IN (2, 3, 5) OR (seq % 10 = 7 AND (seq % 40) % 4 <> 0) AS bad, seq % 3 = 0 AS paid, * EXCLUDE (id, seq) FROM postings"
)
ORACLES["decode_model_json"] = ctes(postings=POSTINGS, answers=_ANSWERS) + (
    "SELECT raw_id, CASE WHEN bad THEN '[PARSE FAILED]' WHEN seq % 10 = 4 THEN '[UNKNOWN]' ELSE concat(segment, ' Engineer') END AS job_title, "
    "CASE WHEN NOT bad THEN employer END AS company, CASE WHEN NOT bad THEN place END AS location, NOT bad AND seq % 2 = 0 AS remote, "
    "CASE WHEN NOT bad AND paid THEN CAST(floor(price) AS INT) END AS salary_min, CASE WHEN NOT bad AND paid THEN CAST(floor(price * 2) AS INT) END AS salary_max, "
    "CASE WHEN NOT bad AND paid THEN 'USD' END AS salary_currency, CASE WHEN NOT bad AND paid THEN 'yearly' END AS salary_period, "
    "CASE WHEN bad OR seq % 10 = 6 THEN '' ELSE concat(segment, '|SQL') END AS skills, "
    "CASE WHEN NOT bad THEN CAST((seq % 40) / CASE WHEN seq % 10 = 7 THEN 4 ELSE 1 END AS INT) END AS years_experience, "
    "CASE WHEN bad THEN 0.0 ELSE CAST(seq % 100 AS DOUBLE) / 100 END AS confidence, CASE WHEN bad THEN 1 ELSE 0 END AS warnings FROM answers"
)
ORACLES["parse_generic_uncut"] = ORACLES["clean_description_uncut"]
ORACLES["hybrid_overlay"] = ctes(**_FIELDS, answers=_ANSWERS) + (
    "SELECT s.raw_id, CASE WHEN good THEN CASE WHEN seq % 10 = 4 THEN '[UNKNOWN]' ELSE concat(segment, ' Engineer') END ELSE s.job_title END AS job_title, "
    "CASE WHEN good THEN 'stub' ELSE s.model_used END AS model_used, CASE WHEN good THEN CAST(seq % 100 AS DOUBLE) / 100 ELSE s.confidence END AS confidence, "
    f"CASE WHEN good THEN '' WHEN s.warnings = '' THEN {q(P.FELL_BACK)} ELSE concat(s.warnings, '|', {q(P.FELL_BACK)}) END AS warnings "
    "FROM structured s JOIN (SELECT *, NOT bad AND CAST(seq % 100 AS DOUBLE) / 100 >= 0.3 AS good FROM answers) a USING (raw_id)"
)
ORACLES["hybrid_parse"] = ORACLES["hybrid_overlay"]
_CALLS = dict(
    postings=POSTINGS,
    sized=f"SELECT id AS raw_id, length({prompt(T)}) AS n FROM postings",
    calls="SELECT raw_id, n, n % 7 <> 0 AND n % 5 <> 0 AS main, (n % 7 = 0 OR n % 5 = 0) AND n % 2 = 0 AS second FROM sized",
)
ORACLES["extract_with_model"] = ctes(**_CALLS) + (
    "SELECT raw_id, CASE WHEN main THEN concat('Role ', n) WHEN second THEN concat('Second ', n) ELSE '[PARSE FAILED]' END AS job_title, "
    "CASE WHEN main THEN 0.9 WHEN second THEN 0.8 ELSE 0.0 END::DOUBLE AS confidence, CASE WHEN second THEN 'second' ELSE 'first' END AS model_used, "
    "CASE WHEN main THEN 0 ELSE 3 END AS failed_attempts, second AS used_fallback FROM calls"
)
ORACLES["extract_with_model_once"] = f"SELECT raw_id, job_title, confidence, model_used, used_fallback FROM ({ORACLES['extract_with_model']})"
ORACLES["parse_stats"] = ctes(**_CALLS) + (
    "SELECT CASE WHEN second THEN 'second' ELSE 'first' END AS model_used, count(*) FILTER (main OR second) AS parsed, "
    "count(*) FILTER (NOT main AND NOT second) AS errors, CAST(sum(CASE WHEN main THEN 0 ELSE 3 END) AS BIGINT) AS retries, "
    "count(*) FILTER (second) AS fallbacks FROM calls GROUP BY 1"
)
ORACLES["parse_failure_row"] = (
    "SELECT CAST(event_id AS VARCHAR) AS raw_id, '[PARSE FAILED]' AS job_title, CAST(0.0 AS DOUBLE) AS confidence, 'stub' AS model_used, props AS warnings "
    "FROM events WHERE event_type = 'error'"
)


# ── validation ──────────────────────────────────────────────────────────────────────────────────

_MONEY = "{} IS NOT NULL AND {} <> 0"
RULES = {
    "rule_title": f"CASE WHEN coalesce(job_title, '') IN ('', '[UNKNOWN]', '[PARSE FAILED]') THEN {q(R.NO_TITLE)} END",
    "rule_skills": f"CASE WHEN skill_count = 0 THEN {q(R.NO_SKILLS)} END",
    "rule_confidence": "CASE WHEN confidence < 0.5 THEN concat('Low LLM confidence (', CAST(round_even(confidence * 100, 0) AS INT), '%) — review extraction carefully') END",
    "rule_salary": (
        "CASE WHEN lo <> 0 AND lo < 10000 THEN concat('Suspiciously low salary min: ', lo) "
        "WHEN hi <> 0 AND hi > 5000000 THEN concat('Suspiciously high salary max: ', hi) "
        "WHEN lo <> 0 AND hi <> 0 AND lo > hi THEN concat('Salary min (', lo, ') exceeds max (', hi, ')') END"
    ),
    "rule_parse_failed": f"CASE WHEN contains(job_title, '[PARSE FAILED]') THEN {q(R.PARSE_FAILED)} END",
    "rule_company": f"CASE WHEN coalesce(company, '') = '' THEN {q(R.NO_COMPANY)} END",
    "rule_location": f"CASE WHEN coalesce(location, '') = '' AND NOT remote THEN {q(R.NO_LOCATION)} END",
    "rule_employment_type": f"CASE WHEN coalesce(employment_type, '') = '' THEN {q(R.NO_EMPLOYMENT)} END",
}
for _name, _case in RULES.items():
    ORACLES[_name] = ctes(jobs=JOBS) + f"SELECT id, {_case} AS issue FROM jobs"


def issue_list(cases) -> str:
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


_STANDARD = issue_list(list(RULES.values())[:5])
_STRICT = issue_list(RULES.values())
for _name, _list in (("validate_standard", _STANDARD), ("validate_strict", _STRICT)):
    ORACLES[_name] = ctes(jobs=JOBS) + f"SELECT id, array_to_string({_list}, '|') AS issues, len({_list}) = 0 AS is_valid FROM jobs"

_COUNTS = (
    "count(*) AS parsed, count(*) FILTER (job_title NOT LIKE '%[PARSE FAILED]%' AND n_issues = 0) AS validated, "
    "count(*) FILTER (job_title NOT LIKE '%[PARSE FAILED]%' AND n_issues > 0) AS flagged, count(*) FILTER (job_title LIKE '%[PARSE FAILED]%') AS errors"
)
ORACLES["validation_outcome"] = ctes(jobs=JOBS, checked=f"SELECT *, len({_STANDARD}) AS n_issues FROM jobs") + (
    f"SELECT employment_type, {_COUNTS}, round(avg(confidence), 6) AS avg_confidence FROM checked GROUP BY 1"
)


def graded(rows: str) -> str:
    """Number of standard issues of extracted rows."""
    return (
        f"SELECT *, (job_title IN ('', '[UNKNOWN]', '[PARSE FAILED]'))::INT + (skills = '')::INT + (confidence < 0.5)::INT "
        f"+ (coalesce(salary_min < 10000, false))::INT + contains(job_title, '[PARSE FAILED]')::INT AS n_issues FROM {rows}"
    )


ORACLES["outcome_per_source"] = ctes(**_FIELDS, checked=graded("generic")) + (
    f"SELECT source, {_COUNTS}, round(avg(confidence), 6) AS avg_confidence FROM checked JOIN postings ON id = raw_id GROUP BY 1"
)


# ── union, deduplication, limits ────────────────────────────────────────────────────────────────

def kept_first(by: str, bypass: str = "false") -> str:
    return f"({bypass} OR row_number() OVER (PARTITION BY {by} ORDER BY seq) = 1)"


_KEYS = dict(
    postings=POSTINGS,
    keys=f"SELECT *, {fp(T)} AS fp FROM postings",
    by_id=f"SELECT * FROM keys QUALIFY {kept_first('external_id', 'external_id IS NULL')}",
    kept=f"SELECT * FROM by_id QUALIFY {kept_first('fp')}",
)
_RAW = "seq, source, external_id, raw_text, CAST(NULL AS VARCHAR) AS source_url"
ORACLES["union_sources"] = ctes(postings=POSTINGS) + (
    "SELECT seq, source, external_id, CAST(length(raw_text) AS INT) AS chars FROM postings UNION ALL "
    "SELECT doc_id, 'manual', NULL, CAST(length(text) AS INT) FROM documents"
)
ORACLES["dedup_within_fetch"] = ctes(postings=POSTINGS, units="SELECT *, concat(source, '|', seq % 3) AS unit FROM postings") + (
    f"SELECT seq, unit, external_id FROM units QUALIFY {kept_first(chr(117) + 'nit, coalesce(external_id, ' + q('') + ')')}"
)
ORACLES["dedup_external_id"] = ctes(**_KEYS) + "SELECT seq, source, external_id FROM by_id"
_DOC_KEYS = dict(
    keys=f"SELECT doc_id AS seq, source, {fp('text')} AS fp FROM documents",
    kept=f"SELECT * FROM keys QUALIFY {kept_first('fp')}",
)
ORACLES["dedup_fingerprint"] = ctes(**_DOC_KEYS) + "SELECT seq, source, fp FROM kept"
ORACLES["dedup_postings"] = ctes(**_KEYS) + f"SELECT {_RAW} FROM kept"
ORACLES["take_target"] = ctes(**_KEYS) + f"SELECT {_RAW} FROM kept ORDER BY seq LIMIT {Q.TARGET}"
_STATS = (
    "SELECT source, count(k.seq) AS kept, count(*) - count(k.seq) AS dropped FROM keys s LEFT JOIN {kept} k USING (seq, source) "
    "{where} GROUP BY source"
)
ORACLES["dedup_stats"] = ctes(**_DOC_KEYS) + _STATS.format(kept="kept", where="")
_CUT = dict(
    taken="SELECT * FROM kept ORDER BY seq LIMIT 2000",
    cut="SELECT CASE WHEN count(*) >= 2000 THEN max(seq) ELSE 9223372036854775807 END AS seq FROM taken",
)
_CUT_STATS = _STATS.format(kept="taken", where="WHERE s.seq <= (SELECT seq FROM cut)")
ORACLES["dedup_stats_until_target"] = ctes(**_KEYS, **_CUT) + _CUT_STATS
ORACLES["dedup_totals"] = ctes(**_KEYS, **_CUT, stats=_CUT_STATS) + (
    "SELECT CAST(sum(kept) AS BIGINT) AS yielded, CAST(sum(dropped) AS BIGINT) AS duplicates, CAST(2000 AS BIGINT) AS target FROM stats"
)
ORACLES["drop_known"] = ctes(postings=POSTINGS) + (
    "SELECT seq, external_id FROM postings p WHERE mark <> 'F' AND NOT EXISTS "
    "(SELECT 1 FROM postings s WHERE s.mark = 'F' AND s.external_id = p.external_id AND s.external_id <> '')"
)
ORACLES["drop_known_by_filter"] = ORACLES["drop_known"]
ORACLES["exists_by_external_id"] = ctes(postings=POSTINGS) + (
    "SELECT external_id, bool_or(mark = 'F') AS known FROM postings WHERE external_id IS NOT NULL GROUP BY 1"
)


# ── sources ─────────────────────────────────────────────────────────────────────────────────────

# Rows are numbered by page and position on it.
_SEQ = f"(seq // {L.PAGE_SIZE}) * 2147483648 + row_number() OVER (PARTITION BY seq // {L.PAGE_SIZE} ORDER BY seq) - 1 AS seq"
_NL = "chr(10)"


def lines(*parts: str) -> str:
    return f"concat_ws({_NL}, {', '.join(parts)})"


def none(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


# Ids are hashes of source and arrival in the shape of a UUID; metadata is compact JSON, nulls written out.
_ID = (
    "array_to_string([substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)], '-') AS id"
)


def identified(sql: str) -> str:
    """The raw rows of a source with their ids."""
    at = sql.index(f"SELECT {_SEQ}")
    head, select = sql[:at], sql[at + len("SELECT ") :]
    return f"{head}SELECT * EXCLUDE (h), {_ID} FROM (SELECT *, md5(concat(source, chr(1), CAST(seq AS VARCHAR))) AS h FROM (SELECT {select}))"


def as_json(**fields: str) -> str:
    return "CAST(to_json({" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}) AS VARCHAR) AS metadata"


_NULL = "CAST(NULL AS VARCHAR)"
ORACLES["unreadable_feeds"] = ctes(postings=POSTINGS) + (
    f"SELECT seq // {L.PAGE_SIZE} AS page_seq, 'unit' AS unit, count(*) AS postings FROM postings WHERE (seq // {L.PAGE_SIZE}) % 7 = 0 GROUP BY 1"
)
ORACLES["raw_from_jsearch"] = ctes(postings=POSTINGS) + (
    f"SELECT {_SEQ}, 'jsearch_api' AS source, CASE WHEN seq % 11 <> 0 THEN concat('j', seq) END AS external_id, "
    + lines(
        "concat('Title: ', segment, ' Engineer')", "concat('Company: ', employer)",
        f"concat('Location: ', CASE WHEN seq % 3 = 0 THEN 'None' ELSE place END, '  Testland')",
        "concat('Remote: ', CASE WHEN seq % 2 = 0 THEN 'True' ELSE 'False' END)", "'Employment Type: FULLTIME'",
        f"concat('Description:', {_NL}, raw_text)",
        "CASE WHEN seq % 4 = 1 AND floor(price) > 0 THEN concat('Salary: ', CAST(floor(price) AS BIGINT), ' - ', CAST(floor(price * 2) AS BIGINT), ' USD YEAR') END",
        f"concat('Qualifications:', {_NL}, '- Degree', {_NL}, '- ', segment)",
    ) + f" AS raw_text, concat('http://jobs.test/', seq) AS source_url, {as_json(employer='employer', posted_at=_NULL, query=q('engineer'))} FROM postings"
)
ORACLES["raw_from_adzuna"] = ctes(postings=POSTINGS) + (
    f"SELECT {_SEQ}, 'adzuna_api' AS source, concat('adzuna_', seq) AS external_id, "
    + lines(
        "concat('Title: ', segment, ' Analyst')", "concat('Company: ', CASE WHEN seq % 5 <> 0 THEN employer ELSE '' END)",
        "concat('Location: ', place)", "concat('Category: ', segment)",
        "concat('Contract Type: ', CASE WHEN seq % 3 = 0 THEN 'permanent' ELSE 'None' END)", f"concat('Description:', {_NL}, raw_text)",
        "CASE WHEN seq % 4 < 2 THEN concat('Salary: ', CAST(floor(price) AS BIGINT), ' - ', "
        "CASE WHEN seq % 4 = 1 THEN CAST(CAST(floor(price * 2) AS BIGINT) AS VARCHAR) ELSE '?' END, ' GBP yearly') END",
    ) + " AS raw_text, concat('http://ads.test/', seq) AS source_url, " + as_json(
        employer="CASE WHEN seq % 5 <> 0 THEN employer END", posted_at=_NULL, category="segment", contract_type="CASE WHEN seq % 3 = 0 THEN 'permanent' END",
    ) + " FROM postings"
)
ORACLES["raw_from_workable"] = ctes(postings=POSTINGS) + (
    f"SELECT {_SEQ}, 'workable' AS source, concat('w', seq) AS external_id, "
    + lines(
        f"concat('Title: ', {none('m_title')})", "concat('Company: ', employer)",
        f"concat('Location: ', {none('m_city')}, ', , ', {none('m_country')})",
        f"concat('Workplace: ', {none('m_workplace')})", f"concat('Employment Type: ', {none('m_employment')})",
        f"concat('Description:', {_NL}, raw_text)",
    ) + " AS raw_text, concat('http://board.test/', seq) AS source_url, " + as_json(
        title="m_title", company="employer", location=f"{{'city': m_city, 'subregion': {_NULL}, 'countryName': m_country}}",
        employment_type="m_employment", workplace="m_workplace", published_at=_NULL, company_info="{'title': employer}",
    ) + " FROM postings"
)
ORACLES["raw_from_rss"] = ctes(postings=POSTINGS) + (
    f"SELECT {_SEQ}, 'indeed_rss' AS source, concat('g', seq) AS external_id, {strip(T)} AS raw_text, "
    f"CASE WHEN seq % 3 = 0 THEN '' ELSE concat('http://feed.test/', seq) END AS source_url, "
    + as_json(title="concat(segment, ' Engineer')", pub_date="''", query=q("engineer")) + f" FROM postings WHERE (seq // {L.PAGE_SIZE}) % 7 <> 0"
)
for _name in ("raw_from_jsearch", "raw_from_adzuna", "raw_from_workable", "raw_from_rss"):
    ORACLES[_name] = identified(ORACLES[_name])

ORACLES["streaming_landed"] = " UNION ALL ".join(
    f"SELECT source, external_id, raw_text, source_url FROM ({ORACLES[n]})" for n in ("raw_from_workable", "raw_from_rss")
)

_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)


def unescape(x: str) -> str:
    for name, char in _ENTITIES:
        x = f"replace({x}, {q(name)}, {q(char)})"
    return x


_ANCHOR = q(r'(?s)<a href="([^"]*)"[^>]*>(.*?)</a>')


def _links(board: H.Board) -> str:
    mark = " OR ".join(f"starts_with(href, {q(p)})" if board.at_start else f"contains(href, {q(p)})" for p in board.link_parts)
    url = f"concat({q(board.host)}, href)"
    if not board.at_start:
        url = f"CASE WHEN starts_with(href, 'http') THEN href ELSE {url} END"
    return ctes(
        search=I.plain(L.SEARCH_PAGE),
        anchors=(
            f"SELECT page_seq, unit, generate_subscripts(regexp_extract_all(payload, {_ANCHOR}, 1), 1) - 1 AS pos, "
            f"unnest(regexp_extract_all(payload, {_ANCHOR}, 1)) AS href, unnest(regexp_extract_all(payload, {_ANCHOR}, 2)) AS body FROM search"
        ),
        named=f"SELECT * EXCLUDE (href, body), {unescape('href')} AS href, {strip(unescape('body'))} AS title FROM anchors",
    ) + f"SELECT page_seq * 2147483648 + pos AS seq, unit, title, {url} AS url FROM named WHERE ({mark}) AND length(title) > 5"


_HIDDEN = q(r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>")


def visible(x: str) -> str:
    pieces = f"string_split(regexp_replace({x}, {_HIDDEN}, chr(1), 'g'), chr(1))"
    return f"array_to_string(list_filter(list_transform({pieces}, lambda s: {strip(unescape('s'))}), lambda s: s <> ''), {_NL})"


def _detail_ctes(board: H.Board) -> dict[str, str]:
    marks = [f"contains(payload, '<article class=\"wide job-details\">')"] if "job-details" in board.content else []
    marks += ["contains(payload, '<article class=\"content\">')"] if "content" in board.content else []
    marks += ["contains(payload, '<article id=\"content\">')"] if board.ids_too else []
    article = r"regexp_extract(payload, '(?s)<article[^>]*>(.*)</article>', 1)"
    return dict(
        detail=I.plain(L.DETAIL_PAGE),
        texts=f"SELECT url, {unescape(strip(chr(114) + 'egexp_extract(payload, ' + q('(?s)<title>(.*?)</title>') + ', 1)'))} AS title, "
              f"CASE WHEN {' OR '.join(marks) or 'false'} THEN {visible(article)} ELSE '' END AS part, {visible('payload')} AS page FROM detail",
        detail_text=f"SELECT url, concat('Title: ', title, {_NL}, {_NL}, CASE WHEN part <> '' THEN part ELSE page END) AS raw_text FROM texts",
    )


for _b in H.BOARDS.values():
    ORACLES[f"html_job_links_{_b.source}"] = _links(_b)
    ORACLES[f"html_detail_text_{_b.source}"] = ctes(**_detail_ctes(_b)) + "SELECT url, raw_text FROM detail_text"
ORACLES["raw_from_html"] = ctes(
    **_detail_ctes(H.BOARDS["jobgurus"]),
    links="SELECT page_id AS seq, concat('unit', page_id % 7) AS unit, concat('Job ', page_id) AS title, url FROM pages",
    firsts=f"SELECT * FROM links QUALIFY {kept_first('unit, url')}",
) + (
    "SELECT seq, unit, url AS external_id, concat('{\"title\":\"', title, '\",\"query\":\"engineer\"}') AS metadata, raw_text "
    "FROM firsts JOIN detail_text USING (url)"
)
ORACLES["raw_manual"] = (
    "SELECT doc_id AS seq, 'manual' AS source, CAST(NULL AS VARCHAR) AS external_id, '{}' AS metadata, "
    f"{strip('text')} <> '' AS healthy, CAST(length(text) AS INT) AS chars FROM documents"
)


def country(x: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({x}), {q(p)}) THEN {q(c)}" for p, c in G.COUNTRY_HINTS) + " ELSE 'us' END"


_WORD_LIST = ", ".join(q(w) for w in Q.COUNTRY_WORDS)
ORACLES["country_code"] = (
    f"SELECT c_custkey, location, {country('location')} AS country FROM "
    f"(SELECT c_custkey, concat_ws(' ', c_mktsegment, list_extract([{_WORD_LIST}], CAST(c_custkey % {len(Q.COUNTRY_WORDS)} + 1 AS INT))) AS location FROM customer)"
)
_GRID = ", ".join(f"({q(s)}, {q(w)}, {str(j).lower()}, {p})" for s, w, j, p in G.GRID_RULES)
ORACLES["fetch_grid"] = ctes(
    rules=f"SELECT * FROM (VALUES {_GRID}) t(source, how, joined, pages)",
    spots="SELECT DISTINCT CAST(n_regionkey AS VARCHAR) AS run_id, n_name AS location FROM customer JOIN nation ON c_nationkey = n_nationkey",
    asks="SELECT DISTINCT CAST(n_regionkey AS VARCHAR) AS run_id, c_mktsegment AS query FROM customer JOIN nation ON c_nationkey = n_nationkey",
    placed=(
        "SELECT run_id, source, joined, pages, location FROM rules CROSS JOIN spots WHERE how = 'each' UNION ALL "
        "SELECT run_id, source, joined, pages, min(location) FROM rules CROSS JOIN spots WHERE how = 'first' GROUP BY ALL UNION ALL "
        "SELECT DISTINCT run_id, source, joined, pages, '' FROM rules CROSS JOIN spots WHERE how = 'none'"
    ),
) + (
    "SELECT run_id, source, query, location, CAST(unnest(range(1, pages + 1)) AS INT) AS page, "
    f"concat_ws('|', source, CASE WHEN joined THEN '*' ELSE query END, location) AS unit, "
    f"CASE WHEN source = 'adzuna_api' THEN {country('location')} END AS country FROM placed JOIN asks USING (run_id)"
)
for _window, _days in (*G.RECENCY_DAYS.items(), ("any", G.DEFAULT_DAYS)):
    ORACLES[f"recency_filter_{_window}"] = (
        f"SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '{Q.ASOF}' - INTERVAL {_days} DAY"
    )
ORACLES["remote_only_filter"] = ctes(jobs=JOBS) + "SELECT id FROM jobs WHERE remote"
ORACLES["employment_type_filter"] = "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')"
ORACLES["category_filter"] = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"


# ── tables ──────────────────────────────────────────────────────────────────────────────────────

_JOB_ROW = "id, raw_id, status, job_title, confidence, reviewer_notes"
_CURRENT = dict(
    jobs=JOBS, log=STATUS_LOG,
    last="SELECT job_id, max(row(reviewed_at, event_seq, status, reviewer_notes)) AS e FROM log GROUP BY 1",
    now="SELECT j.* EXCLUDE (status), coalesce(l.e[3], j.status) AS status, coalesce(l.e[4], '') AS reviewer_notes "
        "FROM jobs j LEFT JOIN last l ON j.id = l.job_id",
)
ORACLES["save_raw"] = ctes(postings=POSTINGS) + f"SELECT {_RAW} FROM postings"
ORACLES["save_parsed"] = ORACLES["get_all"] = ctes(jobs=JOBS) + (
    "SELECT id, raw_id, status, job_title, confidence, '' AS reviewer_notes FROM jobs"
)
ORACLES["update_status"] = ctes(jobs=JOBS) + (
    "SELECT id, raw_id, CASE WHEN listed THEN 'rejected' ELSE status END AS status, job_title, confidence, "
    "CASE WHEN listed THEN 'by list' ELSE '' END AS reviewer_notes FROM (SELECT *, n IN (SELECT doc_id FROM labels) AS listed FROM jobs)"
)
ORACLES["current_jobs"] = ctes(**_CURRENT) + f"SELECT {_JOB_ROW} FROM now"
ORACLES["pending_jobs"] = ctes(**_CURRENT) + f"SELECT {_JOB_ROW} FROM now WHERE status = 'parsed' ORDER BY parsed_at, id LIMIT 50"
ORACLES["get_by_id"] = ctes(**_CURRENT) + f"SELECT {_JOB_ROW} FROM now WHERE id = '7'"
ORACLES["status_from_index"] = ORACLES["current_jobs"]
ORACLES["pending_from_index"] = ORACLES["pending_jobs"]
ORACLES["job_from_index"] = ORACLES["get_by_id"]
ORACLES["jobs_from_index"] = ctes(**_CURRENT) + f"SELECT {_JOB_ROW} FROM now WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"
ORACLES["store_stats"] = ctes(**_CURRENT, postings=POSTINGS) + (
    "SELECT 'total' AS section, 'raw' AS name, CAST(count(*) AS DOUBLE) AS value FROM postings UNION ALL "
    "SELECT 'total', 'parsed', count(*) FROM now UNION ALL "
    "SELECT 'total', 'avg_confidence', round(coalesce(avg(confidence), 1.0), 4) FROM now UNION ALL "
    "SELECT 'by_status', status, count(*) FROM now GROUP BY status UNION ALL "
    "SELECT 'by_source', source, count(*) FROM postings GROUP BY source"
)
ORACLES["with_source"] = ctes(**_CURRENT, postings=POSTINGS) + (
    "SELECT w.id, w.raw_id, p.source, w.status FROM now w LEFT JOIN postings p ON w.raw_id = concat('r', p.id)"
)


# ── review and delivery ─────────────────────────────────────────────────────────────────────────

_ASKED = dict(
    jobs=JOBS,
    listed="SELECT concat(CASE WHEN doc_id % 10 = 0 THEN 'none' ELSE '' END, doc_id) AS requested_id FROM labels "
           "UNION ALL SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1",
    asked="SELECT r.requested_id, j.* FROM (SELECT DISTINCT requested_id FROM listed) r LEFT JOIN jobs j ON j.id = r.requested_id",
    ruled="SELECT *, CASE WHEN id IS NULL THEN concat('Job ', requested_id, ' not found') WHEN status NOT IN ('parsed', 'failed') "
          "THEN concat('Job ', requested_id, ' is in status ', status, ', cannot approve') END AS refusal FROM asked",
    tried="SELECT *, refusal IS NULL AND n % 5 > 1 AS ok, CASE n % 5 WHEN 0 THEN 'refused' WHEN 1 THEN 'down' END AS error FROM ruled",
    rejected="SELECT requested_id, id IS NOT NULL AS success, id AS job_id, CASE WHEN id IS NOT NULL THEN 'rejected' END AS status, "
             "CASE WHEN id IS NULL THEN concat('Job ', requested_id, ' not found') ELSE '' END AS message FROM asked",
    queue=f"SELECT * FROM (SELECT *, len({_STANDARD}) AS n_issues FROM jobs) WHERE status = 'parsed' ORDER BY parsed_at, id LIMIT 1000",
)


def approved(ok: str, error: str) -> str:
    return (
        f"SELECT requested_id, {ok} AS success, CASE WHEN refusal IS NULL THEN requested_id END AS job_id, "
        f"CASE WHEN {ok} THEN 'sent' END AS status, coalesce(refusal, {error}, '') AS message FROM tried"
    )


ORACLES["approve"] = ctes(**_ASKED) + approved("ok", "error")
ORACLES["approve_events"] = ctes(**_ASKED) + (
    "SELECT id AS job_id, CASE WHEN ok THEN 'sent' ELSE 'failed' END AS status, CASE WHEN ok THEN 'fine' ELSE error END AS reviewer_notes "
    "FROM tried WHERE refusal IS NULL"
)
ORACLES["reject"] = ctes(**_ASKED) + "SELECT * FROM rejected"
ORACLES["approve_batch"] = ctes(**_ASKED, done=approved("(refusal IS NULL)", "''")) + "SELECT d.* FROM listed JOIN done d USING (requested_id)"
ORACLES["bulk_action"] = ctes(**_ASKED) + (
    "SELECT id AS requested_id, true AS success, id AS job_id, 'rejected' AS status, '' AS message FROM queue "
    f"WHERE confidence >= {Q.THRESHOLD} AND n_issues = 0"
)
ORACLES["bulk_action_all"] = ctes(jobs=JOBS) + (
    "SELECT id AS requested_id, true AS success, id AS job_id, 'rejected' AS status, '' AS message FROM jobs "
    f"WHERE status = 'parsed' AND confidence >= {Q.THRESHOLD} AND len({_STANDARD}) = 0"
)
ORACLES["auto_approve"] = ctes(jobs=JOBS) + (
    f"SELECT id FROM jobs WHERE status = 'parsed' AND confidence >= {Q.THRESHOLD} AND len({_STANDARD}) = 0"
)
ORACLES["to_payload"] = ORACLES["write_jsonl"] = ctes(jobs=JOBS) + (
    "SELECT id AS job_id, job_title, company, location, remote, lo AS salary_min, hi AS salary_max, 'USD' AS salary_currency, "
    "array_to_string(list_slice(['Python', 'SQL', 'Spark'], 1, skill_count), '|') AS skills, employment_type, "
    "CAST(NULL AS VARCHAR) AS description FROM jobs"
)
ORACLES["deliver"] = ctes(jobs=JOBS) + (
    "SELECT id AS job_id, n % 5 > 1 AS ok, CASE WHEN n % 5 = 1 THEN 3 ELSE 1 END AS attempts, "
    "CASE n % 5 WHEN 0 THEN 'refused' WHEN 1 THEN 'down' END AS error FROM jobs"
)
ORACLES["deliver_through_outbox"] = ORACLES["deliver"]
ORACLES["delivery_status"] = ctes(jobs=JOBS) + (
    "SELECT id AS job_id, CASE WHEN n % 5 > 1 THEN 'sent' ELSE 'failed' END AS status, "
    "CASE n % 5 WHEN 0 THEN 'refused' WHEN 1 THEN 'down' ELSE 'Bulk auto-handoff' END AS reviewer_notes FROM jobs"
)


# ── run statistics ──────────────────────────────────────────────────────────────────────────────

_FILTERS = {
    "fetched": "fetched", "parsed": "parsed", "validated": "outcome = 'validated'", "flagged": "outcome = 'flagged'",
    "errors": "outcome = 'error' OR NOT delivered", "duplicates": "duplicate",
}
_RUN_COUNTS = ", ".join(f"count(*) FILTER ({f}) AS {c}" for c, f in _FILTERS.items())
_SUMMARY = dict(
    records=RECORDS,
    runs="SELECT run_id, min(ts) AS started_at, CASE WHEN count(*) % 9 <> 0 THEN max(ts) END AS finished_at, count(*) % 5 = 0 AS stopped FROM records GROUP BY 1",
    counted=f"SELECT run_id, {_RUN_COUNTS} FROM records GROUP BY 1",
    per="SELECT run_id, string_agg(concat(source, '=', n), '|' ORDER BY source) AS per_source "
        "FROM (SELECT run_id, source, count(*) AS n FROM records WHERE fetched GROUP BY ALL) GROUP BY 1",
    timed="SELECT *, round((epoch_us(finished_at) - epoch_us(started_at)) / 1e6, 2) AS duration_seconds FROM runs JOIN counted USING (run_id) LEFT JOIN per USING (run_id)",
)
_COUNT_NAMES = ", ".join(M.COUNTS)
ORACLES["run_summary"] = ctes(**_SUMMARY) + (
    f"SELECT run_id, {_COUNT_NAMES}, coalesce(per_source, '') AS per_source, duration_seconds, "
    "CASE WHEN duration_seconds > 0 THEN round(parsed / duration_seconds, 2) ELSE 0.0 END AS jobs_per_second FROM timed"
)


def ranked(p: int) -> str:
    return f"max(latency) FILTER (i = least(CAST(floor(CAST({p / 100.0} AS DOUBLE) * n) AS BIGINT), n - 1))"


ORACLES["latency_percentiles"] = ctes(
    records=RECORDS,
    ranks="SELECT run_id, latency, row_number() OVER (PARTITION BY run_id ORDER BY latency) - 1 AS i, count(*) OVER (PARTITION BY run_id) AS n "
          "FROM records WHERE latency IS NOT NULL",
) + "SELECT run_id, " + ", ".join(f"round({ranked(p)}, 4) AS p{p}" for p in M.PERCENTILES) + " FROM ranks GROUP BY 1"
ORACLES["run_latency"] = ORACLES["latency_percentiles"]
ORACLES["lifetime_latency"] = ctes(records=RECORDS) + (
    "SELECT count(latency) AS seen, count(latency) AS latencies, true AS p50_close, true AS p95_close, true AS p99_close FROM records"
)
ORACLES["latency_by_window"] = ctes(
    **_SUMMARY, many="SELECT run_id, count(latency) AS latencies FROM records GROUP BY 1",
) + (
    "SELECT strftime(date_trunc('day', finished_at), '%Y-%m-%d') AS day, count(*) AS runs, CAST(sum(latencies) AS BIGINT) AS latencies, true AS rising "
    "FROM runs JOIN many USING (run_id) WHERE finished_at IS NOT NULL GROUP BY 1"
)
ORACLES["lifetime_totals"] = ctes(**_SUMMARY) + (
    "SELECT count(*) AS total_runs, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS total_{c}" for c in ("fetched", "parsed", "errors")) + " FROM timed"
)
ORACLES["source_totals"] = ctes(records=RECORDS) + "SELECT source, count(*) AS total FROM records WHERE fetched GROUP BY 1"
ORACLES["source_errors"] = ctes(records=RECORDS) + "SELECT source, count(*) AS errors FROM records WHERE NOT ok GROUP BY 1"
ORACLES["recent_runs"] = ctes(**_SUMMARY) + (
    f"SELECT run_id, {_COUNT_NAMES} FROM timed WHERE finished_at IS NOT NULL ORDER BY finished_at DESC, run_id DESC LIMIT 10"
)
ORACLES["run_status"] = ctes(**_SUMMARY) + (
    "SELECT run_id, CASE WHEN stopped THEN 'failed' WHEN finished_at IS NULL THEN 'running' ELSE 'completed' END AS state FROM runs"
)
ORACLES["cycle_stats"] = ctes(records=RECORDS) + (
    "SELECT source, count(*) AS fetched, count(*) FILTER (delivered) AS parsed, count(*) FILTER (delivered) AS handoff_ok, "
    "count(*) FILTER (NOT coalesce(delivered, false)) AS errors FROM records GROUP BY 1"
)
_HOUR = "SELECT source, time_bucket(INTERVAL 1 HOUR, CAST(ts AS TIMESTAMP)) AS h, count(*) AS tries, count(*) FILTER (NOT ok) AS failures FROM records GROUP BY ALL"
_AT = "'%Y-%m-%d %H:%M:%S'"
ORACLES["fetch_windows"] = ctes(records=RECORDS, hours=_HOUR) + (
    f"SELECT source, strftime(h, {_AT}) AS window_start, strftime(h + INTERVAL 1 HOUR, {_AT}) AS window_end, tries, failures FROM hours"
)
ORACLES["streaming_fetch_windows"] = ctes(records=RECORDS, hours=_HOUR) + f"SELECT source, strftime(h, {_AT}) AS window_start, tries, failures FROM hours"
ORACLES["failure_sessions"] = ctes(
    records=RECORDS,
    failed="SELECT source, CAST(ts AS TIMESTAMP) AS ts, lag(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY source ORDER BY ts) AS before FROM records WHERE NOT ok",
    numbered="SELECT *, count(*) FILTER (before IS NULL OR ts - before > INTERVAL 2 HOUR) OVER (PARTITION BY source ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM failed",
) + (
    f"SELECT source, strftime(min(ts), {_AT}) AS session_start, epoch_us(max(ts) + INTERVAL 2 HOUR) AS end_us, count(*) AS failures FROM numbered GROUP BY source, k"
)
ORACLES["progress"] = "SELECT 'validating' AS step, count(*) AS current FROM orders"
_STREAKS = dict(
    records=RECORDS,
    islands="SELECT source_id AS source, ts, seq, ok, sum(ok::INT) OVER (PARTITION BY source_id ORDER BY ts, seq) AS island FROM records",
    streaks="SELECT source, ts, seq, ok, CAST(sum((NOT ok)::INT) OVER (PARTITION BY source, island ORDER BY ts, seq) AS BIGINT) AS streak FROM islands",
)
ORACLES["failure_streaks"] = ctes(**_STREAKS) + "SELECT source, seq, streak FROM streaks"
ORACLES["breaker_stats"] = ctes(
    **_STREAKS,
    totals="SELECT source, arg_max(streak, row(ts, seq)) AS consecutive_failures, count(*) FILTER (NOT ok) AS total_failures, "
           "count(*) FILTER (ok) AS total_successes, max(ts) FILTER (NOT ok) AS last FROM streaks GROUP BY 1",
) + (
    "SELECT source, CASE WHEN consecutive_failures < 2 THEN 'closed' WHEN TIMESTAMP '2024-02-15 00:00:00' - last >= INTERVAL 30 DAY "
    "THEN 'half_open' ELSE 'open' END AS state, consecutive_failures, total_failures, total_successes FROM totals"
)

_PROBE = "r.opened >= 0 AND a.us - r.opened >= 86400000000"
_SKIP = "r.opened >= 0 AND a.us - r.opened < 86400000000"
ORACLES["breaker_timeline"] = "WITH RECURSIVE" + ctes(
    records=RECORDS,
    attempts="SELECT source_id AS source, epoch_us(ts) AS us, seq, ok, row_number() OVER (PARTITION BY source_id ORDER BY ts, seq) AS k FROM records",
    walk=(
        "SELECT DISTINCT source, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS opened, CAST(0 AS BIGINT) AS failures, CAST(NULL AS BIGINT) AS seq, "
        "true AS ok, '' AS state, false AS skipped FROM attempts UNION ALL "
        f"SELECT a.source, a.k, CASE WHEN {_SKIP} THEN r.opened WHEN a.ok THEN -1 WHEN {_PROBE} OR r.failures + 1 >= 3 THEN a.us ELSE r.opened END, "
        f"CASE WHEN {_SKIP} THEN r.failures WHEN a.ok THEN 0 ELSE r.failures + 1 END, a.seq, a.ok, "
        f"CASE WHEN {_PROBE} THEN 'half_open' WHEN {_SKIP} THEN 'open' ELSE 'closed' END, {_SKIP} "
        "FROM walk r JOIN attempts a ON a.source = r.source AND a.k = r.k + 1"
    ),
).removeprefix("WITH") + "SELECT source, seq, ok, state, skipped, failures AS consecutive FROM walk WHERE k > 0"


# ── whole jobs ──────────────────────────────────────────────────────────────────────────────────

_DOC_FIELDS = dict(
    **salaries("documents", "doc_id", "text"),
    found=(
        f"SELECT coalesce(nullif({first_match('text', X.TITLE_PATTERNS)}, ''), '[UNKNOWN]') AS job_title, {skills('text')} AS skills, "
        "lo AS salary_min FROM documents LEFT JOIN pay ON doc_id = k"
    ),
    scored="SELECT *, CASE WHEN job_title = '[UNKNOWN]' THEN 0.3 ELSE 0.5 END AS confidence FROM found",
)
ORACLES["ingest_manual"] = ctes(**_DOC_FIELDS, checked=graded("scored")) + (
    "SELECT true AS success, 'sent' AS status, n_issues AS issues, count(*) AS jobs, count(*) AS written FROM checked GROUP BY ALL"
)
ORACLES["ingest_two_runs"] = (
    "SELECT 'run-9' AS run_id, 'sent' AS status, count(*) AS jobs, count(*) AS ids FROM documents UNION ALL "
    "SELECT 'run-10', 'rejected', count(*), count(*) FROM documents"
)
_NEW = "NOT EXISTS (SELECT 1 FROM postings s WHERE s.mark = 'F' AND s.external_id = kept.external_id AND s.external_id <> '')"
ORACLES["bulk_ingest"] = ctes(
    **_FIELDS, **{k: v for k, v in _KEYS.items() if k != "postings"},
    fresh=f"SELECT id FROM kept WHERE {_NEW}",
    graded=graded("structured"),
    done=f"SELECT {_COUNTS} FROM graded WHERE raw_id IN (SELECT id FROM fresh)",
    per="SELECT string_agg(concat(source, '=', n), '|' ORDER BY source) AS per_source FROM (SELECT source, count(*) AS n FROM kept GROUP BY 1)",
) + (
    "SELECT (SELECT count(*) FROM kept) AS fetched, parsed, validated, flagged, errors, "
    "(SELECT count(*) FROM keys) - (SELECT count(*) FROM fresh) AS duplicates, per_source FROM done, per"
)
ORACLES["streaming_ingest"] = ORACLES["dedup_postings"]
ORACLES["streaming_ingest_in_state"] = ctes(postings=POSTINGS) + (
    "SELECT external_id, CASE WHEN external_id IS NULL THEN count(*) ELSE 1 END AS rows FROM postings GROUP BY 1"
)
ORACLES["review_queue"] = ctes(**_FIELDS, checked=graded("structured")) + (
    "SELECT CASE WHEN confidence >= 0.5 AND n_issues = 0 THEN 'sent' ELSE 'parsed' END AS status, count(*) AS jobs, "
    "count(CASE WHEN confidence >= 0.5 AND n_issues = 0 THEN 1 END) AS written FROM checked GROUP BY 1"
)
