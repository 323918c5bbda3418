"""The same questions as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from eventloom.llm.license_scan import CUES, RULES, SENTENCES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def substring_dedup(width: int = 35) -> str:
    """Windows as lists of words, counted; a word goes if a window over it counts twice."""
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
h AS (SELECT doc_id,
             unnest(list_transform(range(1, len(w) - {width - 2}),
               lambda i: sha256(array_to_string(w[i:i + {width - 1}], ' ')))) AS k,
             unnest(range(1, len(w) - {width - 2})) AS i
      FROM d WHERE len(w) >= {width}),
r AS (SELECT doc_id, list(i ORDER BY i) AS starts
      FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS n FROM h) WHERE n > 1
      GROUP BY doc_id),
g AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (
        SELECT doc_id, unnest(range(a, a + {width})) AS p FROM (
          SELECT doc_id, unnest(starts) AS a FROM r)) GROUP BY doc_id),
p AS (SELECT d.doc_id, unnest(d.w) AS x, unnest(range(1, len(d.w) + 1)) AS i FROM d),
x AS (SELECT p.doc_id, p.x, p.i FROM p ANTI JOIN (
        SELECT doc_id, unnest(gone) AS i FROM g) q ON p.doc_id = q.doc_id AND p.i = q.i),
k AS (SELECT doc_id, array_to_string(list(x ORDER BY i), ' ') AS kept, count(*) AS n FROM x
      GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""


def jaccard_classes(width: int = 3, percent: int = 90) -> str:
    """All pairs with a common n-gram; labels spread until they no longer change."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = f"translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}')"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(list_transform(
    range(1, greatest(len(w) - {width - 1}, 1) + 1), lambda i: hash(w[i:i + {width - 1}])))) AS g
  FROM d WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
m AS MATERIALIZED (
  SELECT s.doc_id, s.g, n.n FROM s JOIN n ON n.doc_id = s.doc_id
  WHERE s.g IN (SELECT g FROM s GROUP BY g HAVING count(*) > 1)),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM m a JOIN m b ON a.g = b.g AND a.doc_id < b.doc_id
    AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= {percent} * (x.n + y.n - c)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(node, label) AS (
  SELECT a, a FROM ways
  UNION
  SELECT ways.b, reached.label FROM reached JOIN ways ON ways.a = reached.node
  WHERE reached.label < ways.b),
least AS (SELECT node, min(label) AS label FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce(least.label, d.doc_id)::BIGINT AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.node = d.doc_id
"""


def license_scan(gap: int = 2) -> str:
    """Sentences as rows, looked up, listed again; rules applied one inside the other."""
    quoted = lambda s: s.replace("'", "''")
    cue = quoted(CUES)
    names = " ".join(
        f"WHEN regexp_matches(s, '{quoted(p)}') THEN '{name}'" for name, p in SENTENCES.items()
    )
    between = f"(?:[a-z0-9_]+ ){{0,{gap}}}?"
    steps, before = [], "begun"
    for k, (name, rule) in enumerate(RULES):
        pattern = " " + between.join(f"{x} " for x in rule)
        steps.append(
            f"r{k} AS (SELECT doc_id, ids, "
            f"CASE WHEN regexp_matches(rest, '{pattern}') AND NOT list_contains(found, '{name}') "
            f"THEN list_append(found, '{name}') ELSE found END AS found, "
            f"regexp_replace(rest, '{pattern}', ' # ', 'g') AS rest FROM {before})"
        )
        before = f"r{k}"
    return rf"""
WITH p AS (
  SELECT doc_id, unnest(string_split_regex(
    regexp_replace(text, '([.!?])[\x09-\x0D\x20]+([^a-z])', '\1' || chr(10) || '\2', 'g'), '\n')) AS s
  FROM documents WHERE regexp_matches(text, '{cue}')),
q AS (
  SELECT doc_id, row_number() OVER () AS i,
         trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS s
  FROM p WHERE regexp_matches(s, '{cue}')),
named AS (SELECT doc_id, i, CASE {names} END AS id FROM q),
begun AS (
  SELECT doc_id, list(id ORDER BY i) AS ids, []::VARCHAR[] AS found,
         ' ' || string_agg(id, ' ' ORDER BY i) || ' ' AS rest
  FROM named WHERE id IS NOT NULL GROUP BY doc_id),
{", ".join(steps)}
SELECT d.doc_id, coalesce(len(r.ids), 0)::BIGINT AS n_sentences,
       coalesce(array_to_string(r.found, ','), '') AS licences,
       coalesce(array_to_string(list_filter(string_split(r.rest, ' '),
                lambda x: x NOT IN ('', '#')), ','), '') AS unmatched
FROM documents d LEFT JOIN {before} r ON r.doc_id = d.doc_id
"""


def ranked_search(k: int = 50) -> str:
    """Every occurrence of every term as a row; gains of shared terms added up and ranked."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = f"translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}')"
    term = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, {term}) AS t
  FROM documents),
q AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({lower}, {term})) AS term FROM benchmark),
p AS MATERIALIZED (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term),
s AS (SELECT count(*)::BIGINT AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(s.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, s GROUP BY term),
g AS (
  SELECT q.item_id, p.r, sum(w.w * ((1000000000 * p.tf)
           // (1000 * p.tf + 20 * (50 + (50 * len(d.t) * s.n) // s.l))))::BIGINT AS score
  FROM q JOIN p ON p.term = q.term JOIN w ON w.term = q.term JOIN d ON d.r = p.r, s
  GROUP BY q.item_id, p.r),
o AS (
  SELECT g.item_id, d.doc_id, g.score,
         row_number() OVER (PARTITION BY g.item_id ORDER BY g.score DESC, d.doc_id) AS rank
  FROM g JOIN d ON d.r = g.r WHERE g.score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= {k}
"""
