"""SQL twins of the corpus operators that SQL can express, for DuckDB."""

from __future__ import annotations

from fieldmark.llm import spelling, vector_codes


def spelling_variants() -> str:
    """Near words by what is left when one letter is taken out: no index, no groups."""
    return f"""
WITH RECURSIVE steps AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
              ORDER BY i) AS crc_table FROM range(256) t(i)),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, translate(run, '{spelling._UPPER}', '{spelling._LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{spelling.RUN}')) AS run FROM documents)),
coded AS (SELECT run, hex(encode(doc_id || ':' || run)) AS digits FROM runs WHERE length(run) >= {spelling.LEAST_LENGTH}),
hashed AS (
  SELECT run, xor(4294967295, list_reduce(
    list_transform(range(length(digits) // 2), lambda k: CAST('0x' || substr(digits, 2 * k + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM coded, steps),
words AS (
  SELECT CASE WHEN h % {spelling.EVERY} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
vocabulary AS MATERIALIZED (
  SELECT word, count(*) AS n FROM words WHERE length(word) >= {spelling.LEAST_LENGTH}
  GROUP BY 1 HAVING count(*) >= {spelling.LEAST_COUNT}),
shorter AS MATERIALIZED (
  SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT s.word, v.word FROM shorter s JOIN vocabulary v ON s.rest = v.word
  UNION SELECT v.word, s.word FROM shorter s JOIN vocabulary v ON s.rest = v.word),
ranked AS (
  SELECT p.word, p.other, o.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
    row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.other) AS place
  FROM pairs p JOIN vocabulary o ON o.word = p.other),
formed AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= {spelling.RATIO} * v.n THEN other END AS form,
    CASE WHEN other_n >= {spelling.RATIO} * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND r.place = 1),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed r ON r.word = c.root WHERE r.form IS NULL
"""


def vector_codes_sql(
    parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS
) -> str:
    """Every distance of every round, without trees."""
    apart = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    ctes = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_no, vec_id, label, len(embedding) // {parts} AS width,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {vector_codes.SCALE}) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""pieces AS MATERIALIZED (
  SELECT row_no, part, v[part * width + 1 : (part + 1) * width] AS x
  FROM (SELECT *, unnest(range({parts})) AS part FROM kept))""",
        f"books0 AS MATERIALIZED (SELECT part, row_no - 1 AS entry, x FROM pieces WHERE row_no <= {entries})",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""nearest{r} AS MATERIALIZED (
  SELECT row_no, p.part, any_value(p.x) AS x, min({apart} * {entries} + entry) AS best
  FROM pieces p JOIN books{r} b ON b.part = p.part GROUP BY 1, 2)"""
        )
        if r == rounds:
            break
        ctes.append(
            f"""means{r} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x FROM (
    SELECT part, best % {entries} AS entry, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT *, unnest(range(1, len(x) + 1)) AS k FROM nearest{r}) GROUP BY 1, 2, 3) GROUP BY 1, 2)"""
        )
        ctes.append(
            f"""books{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM books{r} b
  LEFT JOIN means{r} m ON m.part = b.part AND m.entry = b.entry)"""
        )
    last = rounds
    return (
        "WITH "
        + ",\n".join(ctes)
        + f""",
digested AS (
  SELECT sha256(string_agg(CAST(x[k] AS VARCHAR), ',' ORDER BY part, entry, k)) AS codebooks_sha256
  FROM (SELECT *, unnest(range(1, len(x) + 1)) AS k FROM books{last})),
coded AS (
  SELECT row_no, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code,
    CAST(sum(best // {entries}) AS BIGINT) AS error FROM nearest{last} GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (row_no), digested"""
    )


ORACLES = {
    "op12_spelling_variants": spelling_variants(),
    "op13_vector_codes": vector_codes_sql(),
}
