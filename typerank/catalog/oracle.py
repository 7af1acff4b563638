"""The same results in SQL, on the same tables, for checking the queries."""

import math
import re

from typerank.functions.text import LONG_WORD, SPACES, TAG
from typerank.operators.stems import STEP_2, STEP_3, STEP_4
from typerank.schemas import (
    BM25_B,
    BM25_K1,
    FEATURES,
    PUNCTUATION,
    PUNCTUATION_WITHOUT_PERIOD,
    QUESTION_WORDS,
    STOP_WORDS,
    TRAIN_QUESTIONS,
)


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(values: list[str]) -> str:
    return "(" + ", ".join(literal(v) for v in values) + ")"


def with_(*ctes: str, select: str) -> str:
    """One statement of common table expressions; repeats are kept once."""
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n" + select


def clean_words(text: str, stop_words: list[str]) -> str:
    stripped = f"regexp_replace({text}, {literal(TAG)}, ' ', 'g')"
    blanks = " " * len(PUNCTUATION_WITHOUT_PERIOD)
    plain = f"translate({stripped}, {literal(PUNCTUATION_WITHOUT_PERIOD)}, {literal(blanks)})"
    split = f"regexp_split_to_array(lower({plain}), {literal(SPACES)})"
    return f"list_filter({split}, lambda w: w <> '' AND w NOT IN {words(stop_words)})"


def preprocess(text: str) -> str:
    return f"array_to_string({clean_words(text, STOP_WORDS)}, ' ')"


def cleaned(text: str) -> str:
    return f"array_to_string({clean_words(text, STOP_WORDS + QUESTION_WORDS)}, ' ')"


def vectorizer_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({preprocess(text)}), {literal(LONG_WORD)})"


# What stays inside a word between two letters, and between two digits; each is replaced by a
# character of private use before the words are cut out.
BETWEEN_LETTERS = "'.‘’＇"
BETWEEN_DIGITS = BETWEEN_LETTERS + ",;"
MARKS = "".join(chr(0xE000 + i) for i in range(len(BETWEEN_DIGITS)))


def word_tokens(text: str) -> str:
    marked = f"lower({text})"
    for kind, inner in ((r"\p{L}", BETWEEN_LETTERS), (r"\p{N}", BETWEEN_DIGITS)):
        for mark, c in zip(MARKS, inner):
            # Twice, since a single letter may stand between two of them.
            for _ in range(2):
                pattern = literal(f"({kind})[{c}]({kind})")
                marked = f"regexp_replace({marked}, {pattern}, {literal(rf'\1{mark}\2')}, 'g')"
    found = f"regexp_extract_all({marked}, {literal(rf'[\p{{L}}\p{{N}}_{MARKS}]+')})"
    plain = f"translate(w, {literal(MARKS)}, {literal(BETWEEN_DIGITS)})"
    possessive = literal("['’＇]s$")
    return f"list_transform({found}, lambda w: regexp_replace({plain}, {possessive}, ''))"


def index_tokens(text: str) -> str:
    return f"list_filter({word_tokens(text)}, lambda w: w NOT IN {words(STOP_WORDS)})"


def local_name(token: str) -> str:
    iri = f"substring({token}, 2, length({token}) - 2)"
    return f"replace(replace(split_part({iri}, '/', -1), '_', ' '), '  ', ' ')"


def abstract(line: str, n_words: int | None) -> str:
    tokens = f"string_split({line}, ' ')"
    text = f"array_to_string({tokens}[3:len({tokens}) - 1], ' ')"
    text = f"replace(replace({text}, '\"', ''), '@en', '')"
    if n_words:
        text = f"array_to_string(string_split({text}, ' ')[1:{n_words}], ' ')"
    return f"translate({text}, {literal(PUNCTUATION)}, '')"


# Inputs

PART_LINES = """part_lines AS (
  SELECT p_partkey * 4 + pos AS ord, lines[pos + 1] AS line
  FROM (
    SELECT p_partkey, [
      subject || ' <http://ex.org/type> <http://ex.org/ontology/' || p_brand || '> .',
      subject || ' <http://ex.org/type> <http://ex.org/ontology/' || p_type || '> .',
      subject || ' <http://ex.org/type> <http://ex.org/owl#Thing> .',
      '# ' || p_name] AS lines
    FROM (SELECT *, '<http://ex.org/resource/' || replace(p_name, ' ', '_') || '_'
                 || p_partkey || '>' AS subject FROM part)
  ), range(4) AS r(pos))"""

PARSED_PARTS = f"""parsed_parts AS (
  SELECT ord, {local_name("string_split(line, ' ')[1]")} AS entity,
         'dbo:' || {local_name("string_split(line, ' ')[3]")} AS type
  FROM part_lines
  WHERE NOT starts_with(line, '#')
    AND {local_name("string_split(line, ' ')[3]")} <> 'owl#Thing')"""

ABSTRACT_LINES = r"""abstract_lines AS (
  SELECT doc_id AS ord, '<http://ex.org/resource/' || source || '/' || doc_id
         || '> <http://ex.org/abstract> "' || regexp_replace(text, '[\r\n]+', ' ', 'g')
         || '"@en .' AS line
  FROM documents)"""

PAGE_LINES = r"""page_lines AS (
  SELECT page_id AS ord, '<' || url || '> <http://ex.org/abstract> "'
         || regexp_replace(html, '[\r\n]+', ' ', 'g') || '"@en .' AS line
  FROM pages)"""


def entity_abstracts(lines: str, n_words: int | None) -> str:
    return f"""entity_abstracts AS (
  SELECT entity, arg_max(abstract, ord) AS abstract
  FROM (SELECT ord, {local_name("string_split(line, ' ')[1]")} AS entity,
               {abstract("line", n_words)} AS abstract
        FROM {lines} WHERE NOT starts_with(line, '#'))
  GROUP BY entity)"""


TYPE_PIECES = """type_pieces AS (
  SELECT lang AS type, doc_id AS ord, text AS piece FROM documents
  UNION ALL
  SELECT lang || '/' || source, doc_id, text FROM documents)"""


def type_documents(pieces: str, max_chars: int | None = None) -> str:
    text = "' ' || string_agg(piece, ' ' ORDER BY ord)"
    if max_chars:
        text = f"substring({text}, 1, {max_chars})"
    return f"""type_docs AS (
  SELECT type AS doc_id, type, catch_all
  FROM (SELECT type, {text} AS catch_all FROM {pieces} GROUP BY type)
  WHERE type <> '' AND catch_all <> '')"""


QUESTIONS = """questions AS (
  SELECT 'b' || item_id AS id, text AS question FROM benchmark
  UNION ALL
  SELECT 'c' || conv_id || '-' || turn, text FROM conversations)"""

CORPUS = "corpus AS (SELECT doc_id::VARCHAR AS doc_id, text AS catch_all FROM documents)"


def postings(source: str = "corpus", prefix: str = "", text: str = "catch_all") -> tuple[str, ...]:
    """Postings and statistics of a table (doc_id, text)."""
    return (
        f"""{prefix}tokens AS (
  SELECT doc_id, tokens, len(tokens) AS dl
  FROM (SELECT doc_id, {index_tokens(text)} AS tokens FROM {source})
  WHERE len(tokens) > 0)""",
        f"""{prefix}postings AS (
  SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT doc_id, dl, unnest(tokens) AS term FROM {prefix}tokens)
  GROUP BY doc_id, term)""",
        f"{prefix}term_stats AS (SELECT term, count(*) AS df FROM {prefix}postings GROUP BY term)",
        f"""{prefix}field_stats AS (
  SELECT count(*) AS doc_count, avg(dl) AS avgdl FROM {prefix}tokens)""",
    )


def query_terms(source: str, prefix: str = "", text: str = "question") -> tuple[str, ...]:
    """Query terms that the index has."""
    return (
        f"""{prefix}query_terms AS (
  SELECT id, pos, term
  FROM (SELECT id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS term
        FROM (SELECT id, {word_tokens(text)} AS t FROM {source}))
  WHERE term IN (SELECT term FROM {prefix}term_stats))""",
        f"""{prefix}query_counts AS (
  SELECT id, term, count(*) AS n FROM {prefix}query_terms GROUP BY id, term)""",
    )


def bm25(prefix: str = "") -> str:
    return f"""{prefix}bm25 AS (
  SELECT id, doc_id,
         sum(n * ln(1 + (doc_count - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
             * (tf / (tf + {BM25_K1}::DOUBLE * (1 - {BM25_B}::DOUBLE
                + {BM25_B}::DOUBLE * dl / avgdl)))) AS raw
  FROM {prefix}query_counts JOIN {prefix}term_stats USING (term)
       JOIN {prefix}postings USING (term), {prefix}field_stats
  GROUP BY id, doc_id)"""


def hits(k: int, scores: str = "bm25", name: str = "hits") -> str:
    return f"""{name} AS (
  SELECT id, CAST(rank AS INTEGER) AS rank, doc_id, score
  FROM (SELECT id, doc_id, score,
               row_number() OVER (PARTITION BY id ORDER BY score DESC, doc_id) AS rank
        FROM (SELECT id, doc_id, round(raw, 6) AS score FROM {scores}))
  WHERE rank <= {k})"""


SEARCH = (CORPUS, *postings(), QUESTIONS, *query_terms("questions"), bm25())

ITEMS = """items AS (
  SELECT 'b' || item_id AS id, text AS question, item_id AS ord,
         CASE WHEN docs IS NULL THEN 'boolean' WHEN toxic > 1 THEN 'literal'
              ELSE 'resource' END AS category,
         CASE WHEN docs IS NULL THEN ['boolean'] WHEN toxic > 1 THEN ['date']
              ELSE docs END AS type
  FROM benchmark LEFT JOIN (
    SELECT doc_id % (SELECT count(*) FROM benchmark) AS item_id,
           list(doc_id::VARCHAR ORDER BY doc_id) AS docs, sum(toxic) AS toxic
    FROM labels GROUP BY 1) USING (item_id))"""

BLANK = """CASE WHEN len(type) = 1 AND type[1] IN ('boolean', 'string', 'number', 'date')
       THEN [] ELSE type END"""


def item_search(source: str) -> tuple[str, ...]:
    """Candidates of the items in ``source``: five hits, then the missing gold."""
    return (
        CORPUS,
        *postings(),
        *query_terms(source),
        bm25(),
        hits(5),
        f"""gold AS (
  SELECT id, doc_id, min(pos) AS pos
  FROM (SELECT id, generate_subscripts(types, 1) - 1 AS pos, unnest(types) AS doc_id
        FROM (SELECT id, {BLANK} AS types FROM {source}))
  GROUP BY id, doc_id)""",
        """candidates AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY origin, pos) AS INTEGER) AS place,
         doc_id
  FROM (SELECT id, doc_id, 0 AS origin, rank AS pos FROM hits
        UNION ALL
        SELECT id, doc_id, 1, pos FROM gold
        WHERE id IN (SELECT id FROM hits)
          AND NOT EXISTS (SELECT 1 FROM hits h WHERE h.id = gold.id AND h.doc_id = gold.doc_id)))""",
    )


QUERY_FEATURES = """query_features AS (
  SELECT id, CAST(sum(n) AS DOUBLE) AS query_length,
         coalesce(sum(n * ln(doc_count / df)), 0.0) AS query_sum_idf,
         coalesce(max(ln(doc_count / df)), 0.0) AS query_max_idf,
         coalesce(sum(n * ln(doc_count / df)), 0.0) / sum(n) AS query_avg_idf
  FROM query_counts LEFT JOIN term_stats USING (term), field_stats GROUP BY id)"""

QUERY_DOC_FEATURES = """query_doc_features AS (
  SELECT c.id, c.doc_id,
         CAST(sum(CASE WHEN tf IS NULL THEN 0 ELSE n END) AS DOUBLE)
           AS unique_query_terms_in_catch_all,
         CAST(coalesce(sum(n * tf), 0) AS DOUBLE) AS sum_TF_catch_all,
         CAST(coalesce(max(tf), 0) AS DOUBLE) AS max_TF_catch_all,
         CAST(coalesce(sum(n * tf), 0) AS DOUBLE) / sum(n) AS avg_TF_catch_all
  FROM candidates c JOIN query_counts q ON c.id = q.id
       LEFT JOIN postings p ON p.doc_id = c.doc_id AND p.term = q.term
  GROUP BY c.id, c.doc_id)"""

ALL_FEATURES = """features AS (
  SELECT * FROM query_doc_features JOIN query_features USING (id)
  LEFT JOIN (SELECT doc_id, CAST(dl AS DOUBLE) AS doc_length FROM tokens) USING (doc_id))"""


def rounded(columns: list[str]) -> str:
    value = {"doc_length_catch_all": "coalesce(doc_length, 0.0)"}
    return ", ".join(f"round({value.get(c, c)}, 6) AS {c}" for c in columns)


FIRST_ITEMS = f"first_items AS (SELECT * FROM items ORDER BY ord LIMIT {TRAIN_QUESTIONS})"
ALL_ITEMS = "first_items AS (SELECT * FROM items)"


def training(label: str) -> str:
    return with_(
        ITEMS,
        FIRST_ITEMS,
        *item_search("first_items"),
        QUERY_FEATURES,
        QUERY_DOC_FEATURES,
        ALL_FEATURES,
        """resource AS (
  SELECT DISTINCT id, unnest(type) AS doc_id FROM first_items WHERE category = 'resource')""",
        select=f"SELECT id, doc_id, {rounded(FEATURES)}, CAST({label} AS INTEGER) AS label FROM features",
    )


# The ranker: accelerated proximal steps, each from the one before.

RANKER_STEPS = 30


def _join(*parts: str) -> str:
    return ", ".join(parts)


def ranker(training_rows: str, steps: int = RANKER_STEPS) -> tuple[str, ...]:
    """weights(w1.., w10): of the features in their order and the intercept, in units of
    ``scale``. Fixed values: alpha 1e-4, l1 share 0.15, epsilon 0.1."""
    n = len(FEATURES)
    each = range(1, n + 1)
    squares = [f"avg({f} * {f})" for f in FEATURES]
    ctes = [
        f"rows_ AS MATERIALIZED ({training_rows})",
        "scale AS MATERIALIZED (SELECT "
        + _join(*(f"CASE WHEN {q} > 0 THEN sqrt({q}) ELSE 1.0 END AS s{j}" for j, q in zip(each, squares)))
        + " FROM rows_)",
        f"""pace AS MATERIALIZED (
  SELECT 1 / ({n + 1} + 1e-4::DOUBLE * 0.85::DOUBLE / pow(least({_join(*(f's{j}' for j in each))}), 2)) AS step
  FROM scale)""",
        "scaled AS MATERIALIZED (SELECT label, 1.0::DOUBLE AS x10, "
        + _join(*(f"{f} / s{j} AS x{j}" for j, f in zip(each, FEATURES)))
        + " FROM rows_, scale)",
        "at_0 AS (SELECT "
        + _join(*(f"0.0::DOUBLE AS w{j}, 0.0::DOUBLE AS z{j}" for j in range(1, n + 2)))
        + ")",
    ]
    t = 1.0
    for i in range(1, steps + 1):
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        keep, t = (t - 1) / after, after
        found = " + ".join(f"x{j} * z{j}" for j in range(1, n + 2))
        slopes = _join(*(f"-avg(e * x{j}) AS g{j}" for j in range(1, n + 2)))
        ctes.append(f"""slope_{i} AS MATERIALIZED (
  SELECT {slopes} FROM (
    SELECT s.*, greatest(least(label - ({found}), 0.1::DOUBLE), -0.1::DOUBLE) AS e FROM scaled s, at_{i - 1}))""")
        moved = _join(
            *(f"z{j} - step * (g{j} + 1e-4::DOUBLE * 0.85::DOUBLE / pow(s{j}, 2) * z{j}) AS u{j}" for j in each),
            f"z{n + 1} - step * g{n + 1} AS u{n + 1}",
        )
        cut = [f"sign(u{j}) * greatest(abs(u{j}) - step * 1e-4::DOUBLE * 0.15::DOUBLE / s{j}, 0.0)" for j in each]
        cut.append(f"u{n + 1}")
        new = _join(*(f"{c} AS w{j}, w{j} AS old{j}" for j, c in enumerate(cut, 1)))
        ctes.append(f"""at_{i} AS MATERIALIZED (
  SELECT {_join(*(f'w{j}, w{j} + {keep!r}::DOUBLE * (w{j} - old{j}) AS z{j}' for j in range(1, n + 2)))}
  FROM (SELECT {new} FROM (SELECT a.*, step, scale.*, {moved} FROM at_{i - 1} a, slope_{i}, scale, pace)))""")
    ctes.append(
        "weights AS MATERIALIZED (SELECT "
        + _join(*(f"w{j} / s{j} AS w{j}" for j in each), f"w{n + 1}")
        + f" FROM at_{steps}, scale)"
    )
    return tuple(ctes)


def features_of(pairs: str, counts: str, name: str) -> tuple[str, ...]:
    """name(id, doc_id, features..) of the ``pairs`` with the query terms ``counts``."""
    renamed = {"query_features": f"{name}_query", "query_doc_features": f"{name}_pair", "query_counts": counts}
    ctes = []
    for cte in (QUERY_FEATURES, QUERY_DOC_FEATURES, ALL_FEATURES):
        cte = re.sub(r"\b(query_features|query_doc_features|query_counts)\b", lambda m: renamed[m[0]], cte)
        cte = re.sub(r"\bcandidates\b", pairs, cte)
        ctes.append(re.sub(r"^features\b", f"{name}_all", cte))
    value = {"doc_length_catch_all": "coalesce(doc_length, 0.0)"}
    columns = ", ".join(f"{value.get(f, f)} AS {f}" for f in FEATURES)
    return (*ctes, f"{name} AS MATERIALIZED (SELECT id, doc_id, {columns} FROM {name}_all)")


def reranked(pairs: str, features: str, name: str) -> str:
    """name(id, rank, doc_id, score) of the hits ``pairs`` by the weights."""
    score = " + ".join(["w10", *(f"w{j} * {f}" for j, f in enumerate(FEATURES, 1))])
    return f"""{name} AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, first DESC) AS INTEGER) AS rank,
         doc_id, score
  FROM (SELECT f.id, f.doc_id, {score} AS score, h.rank AS first
        FROM {features} f JOIN {pairs} h ON h.id = f.id AND h.doc_id = f.doc_id, weights))"""


RANKER = (
    ITEMS,
    FIRST_ITEMS,
    *item_search("first_items"),
    *features_of("candidates", "query_counts", "training_features"),
    """resource AS (
  SELECT DISTINCT id, unnest(type) AS doc_id FROM first_items WHERE category = 'resource')""",
    *ranker("""SELECT *, CASE WHEN id IN (SELECT id FROM resource) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM training_features"""),
)

RERANKED = (
    *RANKER,
    QUESTIONS,
    *(f"q_{t} AS (SELECT * FROM {t})" for t in ("postings", "term_stats", "field_stats")),
    *query_terms("questions", "q_"),
    bm25("q_"),
    hits(5, "q_bm25", "q_hits"),
    *features_of("q_hits", "q_query_counts", "hit_features"),
    reranked("q_hits", "hit_features", "final"),
)

# Classification

CATEGORY = """CASE lang WHEN 'en' THEN 'resource' WHEN 'de' THEN 'boolean' ELSE 'literal' END"""

EVERY = f"""every AS (
  SELECT doc_id::VARCHAR AS id, text AS question, {CATEGORY} AS category,
         CASE lang WHEN 'en' THEN [lang || '/' || source] WHEN 'de' THEN ['boolean']
              ELSE ['string'] END AS type,
         doc_id IN (SELECT doc_id FROM labels) AS annotated
  FROM documents)"""

COUNTS = (
    EVERY,
    f"""counts AS MATERIALIZED (
  SELECT id, term, count(*) AS n
  FROM (SELECT id, unnest({vectorizer_tokens("question")}) AS term FROM every)
  GROUP BY id, term)""",
    "train AS (SELECT * FROM every WHERE annotated)",
    "train_counts AS (SELECT * FROM counts WHERE id IN (SELECT id FROM train))",
    "vocabulary AS MATERIALIZED (SELECT term, count(*) AS df FROM train_counts GROUP BY term)",
)

NAIVE_BAYES = (
    *COUNTS,
    """class_terms AS (
  SELECT category, term, sum(n) AS n FROM train_counts JOIN train USING (id)
  GROUP BY category, term)""",
    """classes AS (
  SELECT category, ln(n_docs / (SELECT count(*) FROM train)) AS log_prior,
         ln(n_terms + (SELECT count(*) FROM vocabulary)) AS log_total
  FROM (SELECT category, count(*) AS n_docs FROM train GROUP BY category)
       LEFT JOIN (SELECT category, sum(n) AS n_terms FROM class_terms GROUP BY category)
       USING (category))""",
    """likelihoods AS (
  SELECT c.category, v.term, ln(coalesce(t.n, 0) + 1.0::DOUBLE) - log_total AS log_likelihood
  FROM classes c CROSS JOIN vocabulary v
       LEFT JOIN class_terms t ON t.category = c.category AND t.term = v.term)""",
    """nb_scores AS (
  SELECT e.id, c.category, any_value(log_prior) + coalesce(sum(n * log_likelihood), 0.0) AS raw
  FROM every e CROSS JOIN classes c
       LEFT JOIN counts n ON n.id = e.id
       LEFT JOIN likelihoods l ON l.category = c.category AND l.term = n.term
  GROUP BY e.id, c.category)""",
    """predicted AS (
  SELECT id, category, score
  FROM (SELECT id, category, round(raw, 3) AS score,
               row_number() OVER (PARTITION BY id ORDER BY round(raw, 6) DESC, category) AS place
        FROM nb_scores)
  WHERE place = 1)""",
)

SVM_STEPS = 20


def svm(steps: int = SVM_STEPS) -> tuple[str, ...]:
    """svm_predicted(id, category) after ``steps`` subgradient steps. the
    penalty 1e-4, margins compared after nine digits."""
    ctes = [
        *COUNTS,
        "size AS (SELECT count(*) AS n FROM train)",
        """raw_weights AS (
  SELECT id, term, c.n * (ln((1 + size.n) / (1 + df)) + 1) AS w
  FROM counts c JOIN vocabulary USING (term), size)""",
        """vectors AS MATERIALIZED (
  SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS x FROM raw_weights
  UNION ALL SELECT id, '', 1.0 FROM every)""",
        "train_vectors AS MATERIALIZED (SELECT * FROM vectors WHERE id IN (SELECT id FROM train))",
        """pairs AS MATERIALIZED (
  SELECT id, l.category AS label, CASE WHEN t.category = l.category THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y
  FROM train t, (SELECT DISTINCT category FROM train) l)""",
        "sums_0 AS (SELECT ''::VARCHAR AS label, ''::VARCHAR AS term, 0.0::DOUBLE AS s WHERE false)",
    ]
    for t in range(1, steps + 1):
        scale = f"(1e-4::DOUBLE * {t - 1} * any_value(n))" if t > 1 else "1.0"
        ctes.append(f"""violating_{t} AS MATERIALIZED (
  SELECT id, label, y FROM pairs LEFT JOIN (
    SELECT id, label, sum(x * s) / {scale} AS f
    FROM train_vectors JOIN sums_{t - 1} USING (term), size GROUP BY id, label) USING (id, label)
  WHERE round(y * coalesce(f, 0.0), 9) < 1)""")
        ctes.append(f"""sums_{t} AS MATERIALIZED (
  SELECT label, term, sum(s) AS s FROM (
    SELECT label, term, s FROM sums_{t - 1}
    UNION ALL SELECT label, term, x * y FROM train_vectors JOIN violating_{t} USING (id))
  GROUP BY label, term)""")
    ctes.append(f"""svm_weights AS MATERIALIZED (
  SELECT label AS category, term, s / (1e-4::DOUBLE * {steps} * n) AS weight FROM sums_{steps}, size)""")
    ctes.append("""svm_predicted AS (
  SELECT id, category FROM (
    SELECT id, category, row_number() OVER (PARTITION BY id ORDER BY round(sum(x * weight), 9) DESC, category) AS place
    FROM vectors JOIN svm_weights USING (term) GROUP BY id, category)
  WHERE place = 1)""")
    return tuple(ctes)


# Hierarchy and evaluation

HIERARCHY = """hierarchy AS (
  SELECT 'R' || r_regionkey AS type, 1 AS depth, 'owl:Thing' AS parent FROM region
  UNION ALL
  SELECT 'N' || n_nationkey, 2, 'R' || n_regionkey FROM nation
  UNION ALL
  SELECT 'S' || s_suppkey, 3, 'N' || s_nationkey FROM supplier)"""

DOCUMENT_TYPES = """hierarchy AS (
  SELECT DISTINCT lang AS type, 1 AS depth, 'owl:Thing' AS parent FROM documents
  UNION ALL
  SELECT DISTINCT lang || '/' || source, 2, lang FROM documents)"""

CLOSURE = """closure AS (
  SELECT type AS descendant, type AS ancestor, 0 AS steps FROM hierarchy
  UNION ALL
  SELECT c.descendant, h.parent, c.steps + 1
  FROM closure c JOIN hierarchy h ON h.type = c.ancestor
  WHERE h.parent IN (SELECT type FROM hierarchy))"""

DISTANCES = """distances AS (
  SELECT descendant AS type1, ancestor AS type2, steps AS distance FROM closure
  UNION ALL
  SELECT ancestor, descendant, steps FROM closure WHERE steps > 0)"""

LINES = """lines AS (
  SELECT l_orderkey, l_quantity, l_discount, l_returnflag, l_linestatus,
         'X' || l_suppkey AS x, 'S' || l_suppkey AS s, 'N' || s_nationkey AS n,
         'R' || n_regionkey AS r
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey)"""

ANSWERS = (
    LINES,
    """listed AS (
  SELECT l_orderkey, list(type ORDER BY type) AS types
  FROM (SELECT DISTINCT l_orderkey, unnest(
          CASE WHEN l_discount = 0 THEN [x] WHEN l_returnflag = 'R' THEN [n]
               WHEN l_returnflag = 'A' THEN [s, n] ELSE [s] END) AS type
        FROM lines)
  GROUP BY l_orderkey)""",
    """answers AS (
  SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS question,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'boolean' WHEN '2-HIGH' THEN 'literal'
              ELSE 'resource' END AS category,
         CASE o_orderpriority WHEN '1-URGENT' THEN ['boolean']
              WHEN '2-HIGH' THEN [CASE o_orderstatus WHEN 'F' THEN 'date'
                                  WHEN 'O' THEN 'number' ELSE 'string' END]
              ELSE coalesce(types, []) END AS type
  FROM orders LEFT JOIN listed ON l_orderkey = o_orderkey)""",
)

PREDICTIONS = (
    LINES,
    """quantities AS (
  SELECT l_orderkey, type, sum(l_quantity) AS quantity
  FROM (SELECT l_orderkey, l_quantity, unnest([s, n, r]) AS type
        FROM lines)
  GROUP BY l_orderkey, type)""",
    """guesses AS (
  SELECT l_orderkey, list(type ORDER BY quantity DESC, type) AS types
  FROM quantities GROUP BY l_orderkey)""",
    """system AS (
  SELECT id, category,
         CASE category WHEN 'boolean' THEN []
              WHEN 'literal' THEN [CASE o_orderstatus WHEN 'O' THEN 'number' ELSE 'date' END]
              ELSE coalesce(types, []) END AS type
  FROM (SELECT o_orderkey, o_orderkey::VARCHAR AS id, o_orderstatus,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'boolean'
                    WHEN o_orderpriority = '2-HIGH' THEN 'literal'
                    WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 'literal'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
                    ELSE 'resource' END AS category
        FROM orders)
       LEFT JOIN guesses ON l_orderkey = o_orderkey)""",
)


def known_gold(answers: str = "answers") -> str:
    return f"""gold AS (
  SELECT id, category,
         CASE WHEN category = 'resource' THEN coalesce(known, []) ELSE type END AS type
  FROM {answers} LEFT JOIN (
    SELECT id, list(type ORDER BY pos) AS known
    FROM (SELECT id, generate_subscripts(type, 1) AS pos, unnest(type) AS type FROM {answers})
    WHERE type IN (SELECT type FROM hierarchy) GROUP BY id) USING (id)
  WHERE coalesce(question, '') <> '')"""


GAINS = (
    CLOSURE,
    DISTANCES,
    "resource_types AS (SELECT DISTINCT id, unnest(type) AS type FROM gold WHERE category = 'resource')",
    """specific AS (
  SELECT id, type FROM resource_types g
  WHERE NOT EXISTS (
    SELECT 1 FROM resource_types o JOIN closure c ON c.descendant = o.type
    WHERE o.id = g.id AND c.ancestor = g.type AND c.steps > 0))""",
    """ranked AS (
  SELECT id, CAST(generate_subscripts(type, 1) - 1 AS INTEGER) AS pos, unnest(type) AS type FROM system)""",
    """gains AS (
  SELECT r.id, r.pos, any_value(r.type) AS type,
         coalesce(1 - min(d.distance) / any_value(m.h), 0.0) AS gain
  FROM ranked r JOIN specific g ON g.id = r.id
       LEFT JOIN distances d ON d.type1 = r.type AND d.type2 = g.type,
       (SELECT CAST(max(depth) AS DOUBLE) AS h FROM hierarchy) m
  GROUP BY r.id, r.pos)""",
    """ideal AS (
  SELECT id, CAST(pos AS INTEGER) AS pos, gain
  FROM (SELECT id, row_number() OVER (PARTITION BY id ORDER BY gain DESC) - 1 AS pos, gain
        FROM (SELECT g.id, d.type2, 1 - min(d.distance) / any_value(m.h) AS gain
              FROM specific g JOIN distances d ON d.type1 = g.type,
                   (SELECT CAST(max(depth) AS DOUBLE) AS h FROM hierarchy) m
              GROUP BY g.id, d.type2)))""",
)


def _dcg(k: int, name: str) -> str:
    return f"sum(CASE WHEN pos < {k} THEN gain / log2(pos + 2) ELSE 0.0 END) AS {name}_{k}"


NDCG = (
    *GAINS,
    f"found AS (SELECT id, {_dcg(5, 'dcg')}, {_dcg(10, 'dcg')} FROM gains GROUP BY id)",
    f"best AS (SELECT id, {_dcg(5, 'ideal')}, {_dcg(10, 'ideal')} FROM ideal GROUP BY id)",
    """ndcgs AS (
  SELECT id, coalesce(dcg_5, 0.0) AS dcg_5, coalesce(dcg_10, 0.0) AS dcg_10, ideal_5, ideal_10,
         coalesce(dcg_5, 0.0) / ideal_5 AS ndcg_5, coalesce(dcg_10, 0.0) / ideal_10 AS ndcg_10
  FROM best LEFT JOIN found USING (id))""",
)

SCORES = (
    *NDCG,
    """ruled AS (
  SELECT g.id, g.category, g.type, s.type AS predicted, s.category AS predicted_category,
         CASE WHEN s.category IS NULL OR s.category <> g.category THEN 1
              WHEN g.category = 'boolean' THEN 2
              WHEN len(s.type) = 0 THEN 3
              WHEN g.category = 'literal' THEN 4
              WHEN len(g.type) = 0 THEN 5
              ELSE 6 END AS rule
  FROM gold g LEFT JOIN system s USING (id))""",
    """scores AS (
  SELECT id, rule, CASE WHEN rule = 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS accuracy,
         CASE rule WHEN 1 THEN 0.0 WHEN 3 THEN 0.0 WHEN 2 THEN 1.0
              WHEN 4 THEN CASE WHEN type[1] = predicted[1] THEN 1.0 ELSE 0.0 END
              WHEN 6 THEN ndcg_5 END AS ndcg_5,
         CASE rule WHEN 1 THEN 0.0 WHEN 3 THEN 0.0 WHEN 2 THEN 1.0
              WHEN 4 THEN CASE WHEN type[1] = predicted[1] THEN 1.0 ELSE 0.0 END
              WHEN 6 THEN ndcg_10 END AS ndcg_10
  FROM ruled LEFT JOIN ndcgs USING (id))""",
)

ORDERS = (*ANSWERS, *PREDICTIONS, HIERARCHY, known_gold())

ROUNDED_SCORES = """SELECT id, rule, accuracy, round(ndcg_5, 6) AS ndcg_5,
       round(ndcg_10, 6) AS ndcg_10 FROM scores"""

BASELINE = (
    *NAIVE_BAYES,
    TYPE_PIECES,
    type_documents("type_pieces"),
    *postings("type_docs"),
    f"asked AS (SELECT e.id, {cleaned('question')} AS question FROM every e "
    "JOIN predicted p ON p.id = e.id AND p.category = 'resource')",
    *query_terms("asked"),
    bm25(),
    hits(10),
    """system AS (
  SELECT p.id, p.category, coalesce(h.types, []) AS type
  FROM predicted p LEFT JOIN (
    SELECT id, list(doc_id ORDER BY rank) AS types FROM hits GROUP BY id) h ON h.id = p.id)""",
)


def _aliases(prefix: str, of: str) -> tuple[str, ...]:
    """The index ``of`` under the names that another set of queries looks it up by."""
    return tuple(f"{prefix}{t} AS (SELECT * FROM {of}{t})" for t in ("postings", "term_stats", "field_stats"))


def _both_fields(source: str, prefix: str) -> tuple[str, ...]:
    """prefix + hits: the five best of ``source`` over texts and names of the types."""
    text, name = f"{prefix}text_", f"{prefix}name_"
    return (
        *_aliases(text, "text_"),
        *_aliases(name, "name_"),
        *query_terms(source, text),
        bm25(text),
        *query_terms(source, name),
        bm25(name),
        f"""{prefix}both AS (
  SELECT id, doc_id, max(raw) AS raw
  FROM (SELECT * FROM {text}bm25 UNION ALL SELECT * FROM {name}bm25) GROUP BY id, doc_id)""",
        hits(5, f"{prefix}both", f"{prefix}hits"),
    )


LTR_RUN = (
    *NAIVE_BAYES,
    TYPE_PIECES,
    type_documents("type_pieces"),
    *postings("type_docs", "text_"),
    *postings("type_docs", "name_", "type"),
    f"first_train AS (SELECT * FROM train ORDER BY id::BIGINT LIMIT {TRAIN_QUESTIONS})",
    *_both_fields("first_train", "t_"),
    f"""listed AS (
  SELECT id, doc_id, min(pos) AS pos
  FROM (SELECT id, generate_subscripts(types, 1) - 1 AS pos, unnest(types) AS doc_id
        FROM (SELECT id, {BLANK} AS types FROM first_train))
  GROUP BY id, doc_id)""",
    """t_candidates AS (
  SELECT id, doc_id FROM t_hits
  UNION ALL
  SELECT id, doc_id FROM listed
  WHERE id IN (SELECT id FROM t_hits)
    AND NOT EXISTS (SELECT 1 FROM t_hits h WHERE h.id = listed.id AND h.doc_id = listed.doc_id))""",
    *(f"{t} AS (SELECT * FROM text_{t})" for t in ("tokens", "postings", "term_stats", "field_stats")),
    *features_of("t_candidates", "t_text_query_counts", "training_features"),
    "resource AS (SELECT DISTINCT id FROM first_train WHERE category = 'resource')",
    *ranker("""SELECT *, CASE WHEN id IN (SELECT id FROM resource) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM training_features"""),
    *_both_fields("every", "q_"),
    *features_of("q_hits", "q_text_query_counts", "hit_features"),
    reranked("q_hits", "hit_features", "final"),
    """system AS (
  SELECT p.id, p.category,
         CASE WHEN p.category = 'resource' THEN coalesce(h.types, []) ELSE [] END AS type
  FROM predicted p LEFT JOIN (
    SELECT id, list(doc_id ORDER BY rank) AS types FROM final GROUP BY id) h ON h.id = p.id)""",
)


# Stems: a y after a consonant is written Y and counts as a vowel.

V, C = "[aeiouY]", "[^aeiouY]"


def _matches(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def _stem_steps() -> list[str]:
    """One expression over ``w`` a step; ``+`` marks a stem that lost -ed or -ing."""
    cut = lambda n, w="w": f"left({w}, length({w}) - {n})"
    above_0, above_1 = f"^{C}*{V}+{C}", f"^{C}*{V}+{C}+{V}+{C}"
    one, short = f"^{C}*{V}+{C}+{V}*$", f"{C}{V}[^aeiouYwxy]$"
    bare = "rtrim(w, '+')"
    steps = [
        f"""CASE WHEN {_matches('w', '(sses|ies)$')} THEN {cut(2)}
          WHEN ends_with(w, 's') AND length(w) > 1 AND NOT ends_with(w, 'ss') THEN {cut(1)} ELSE w END""",
        f"""CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {_matches(cut(3), above_0)} THEN {cut(1)} ELSE w END
          WHEN ends_with(w, 'ed') AND {_matches(cut(2), V)} THEN {cut(2)} || '+'
          WHEN ends_with(w, 'ing') AND {_matches(cut(3), V)} THEN {cut(3)} || '+' ELSE w END""",
        f"""CASE WHEN NOT ends_with(w, '+') THEN w
          WHEN {_matches(bare, '(at|bl|iz)$')} THEN {bare} || 'e'
          WHEN {_matches(bare, f'{C}{C}$')} AND right({bare}, 1) = left(right({bare}, 2), 1)
            AND right({bare}, 1) NOT IN ('l', 's', 'z') THEN {cut(1, bare)}
          WHEN {_matches(bare, one)} AND {_matches(bare, short)} THEN {bare} || 'e' ELSE {bare} END""",
        f"CASE WHEN right(w, 1) IN ('y', 'Y') AND {_matches(cut(1), V)} THEN {cut(1)} || 'i' ELSE w END",
    ]
    for rules, measure in ((STEP_2, above_0), (STEP_3, above_0), (STEP_4, above_1)):
        cases = []
        for rule in sorted(rules.split(), key=lambda r: -len(r.split(":")[0])):
            old, new = rule.split(":")
            fits = _matches(cut(len(old)), measure)
            if old == "ion":
                fits += " AND " + _matches(cut(3), "[st]$")
            cases.append(f"WHEN ends_with(w, '{old}') THEN CASE WHEN {fits} THEN {cut(len(old))} || '{new}' ELSE w END")
        steps.append("CASE " + "\n          ".join(cases) + " ELSE w END")
    last_e = f"({_matches(cut(1), above_1)} OR ({_matches(cut(1), one)} AND NOT {_matches(cut(1), short)}))"
    steps.append(f"CASE WHEN ends_with(w, 'e') AND {last_e} THEN {cut(1)} ELSE w END")
    steps.append(f"CASE WHEN ends_with(w, 'll') AND {_matches('w', above_1)} THEN {cut(1)} ELSE w END")
    return steps


def stems(source: str) -> tuple[str, ...]:
    """stems(term, stem) of the distinct terms of ``source``."""
    ctes = [
        f"""stem_0 AS (
  SELECT DISTINCT term, regexp_replace(term, '([^aeiou])y', '\\1Y', 'g') AS w FROM {source})"""
    ]
    for i, step in enumerate(_stem_steps()):
        ctes.append(f"stem_{i + 1} AS (SELECT term, {step} AS w FROM stem_{i})")
    ctes.append(
        f"""stems AS MATERIALIZED (
  SELECT term, CASE WHEN length(term) < 3 THEN term ELSE replace(w, 'Y', 'y') END AS stem
  FROM stem_{len(ctes) - 1})"""
    )
    return tuple(ctes)


STEMMED = (
    CORPUS,
    *postings(prefix="surface_"),
    QUESTIONS,
    f"""asked_tokens AS (
  SELECT id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token
  FROM (SELECT id, {word_tokens("question")} AS t FROM questions))""",
    """all_terms AS (SELECT term FROM surface_postings UNION SELECT token FROM asked_tokens)""",
    *stems("all_terms"),
    "tokens AS (SELECT doc_id, dl FROM surface_tokens)",
    """postings AS (
  SELECT doc_id, stem AS term, sum(tf)::BIGINT AS tf, any_value(dl) AS dl
  FROM surface_postings JOIN stems USING (term) GROUP BY doc_id, stem)""",
    "term_stats AS (SELECT term, count(*) AS df FROM postings GROUP BY term)",
    "field_stats AS (SELECT * FROM surface_field_stats)",
    """query_terms AS (
  SELECT id, pos, token, stem AS term FROM asked_tokens JOIN stems ON stems.term = token
  WHERE stem IN (SELECT term FROM term_stats))""",
    "query_counts AS (SELECT id, term, count(*) AS n FROM query_terms GROUP BY id, term)",
    bm25(),
)


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


TWO_FIELDS = with_(
    QUESTIONS,
    TYPE_PIECES,
    type_documents("type_pieces"),
    *postings("type_docs", "text_"),
    *query_terms("questions", "text_"),
    bm25("text_"),
    *postings("type_docs", "name_", "type"),
    *query_terms("questions", "name_"),
    bm25("name_"),
    """both_fields AS (
  SELECT id, doc_id, max(raw) AS raw
  FROM (SELECT * FROM text_bm25 UNION ALL SELECT * FROM name_bm25) GROUP BY id, doc_id)""",
    hits(5, "both_fields"),
    select="SELECT * FROM hits",
)

SQL: dict[str, str] = {
    "triples_entity_types": with_(PART_LINES, PARSED_PARTS, select="SELECT * FROM parsed_parts"),
    "triples_entity_abstracts": with_(
        ABSTRACT_LINES,
        entity_abstracts("abstract_lines", 10),
        select="SELECT * FROM entity_abstracts",
    ),
    "triples_page_abstracts": with_(
        PAGE_LINES,
        entity_abstracts("page_lines", None),
        select="SELECT * FROM entity_abstracts",
    ),
    "type_entity_lists": with_(
        PART_LINES,
        PARSED_PARTS,
        select="""SELECT type, row_number() OVER (PARTITION BY type ORDER BY ord) - 1 AS pos, entity
FROM parsed_parts""",
    ),
    "type_documents": with_(
        TYPE_PIECES, type_documents("type_pieces", 20_000), select="SELECT * FROM type_docs"
    ),
    "type_postings": with_(
        TYPE_PIECES,
        type_documents("type_pieces"),
        *postings("type_docs"),
        select="SELECT * FROM postings",
    ),
    "index_reloaded": with_(
        """loads AS (
  SELECT lang || '/' || source AS doc_id, arg_max(text, doc_id) AS catch_all
  FROM documents GROUP BY lang, source)""",
        *postings("loads"),
        select="SELECT p.*, round(avgdl, 6) AS avgdl FROM postings p, field_stats",
    ),
    "index_upserted": with_(
        """loaded AS (
  SELECT page_id::VARCHAR AS doc_id, html AS catch_all FROM pages
  UNION ALL
  SELECT doc_id::VARCHAR, text FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages))""",
        *postings("loaded"),
        select="""SELECT doc_id, term, tf, dl, df, dl AS doc_length, round(avgdl, 6) AS avgdl, doc_count
FROM postings JOIN term_stats USING (term), field_stats""",
    ),
    "index_documents": """SELECT lang || '/' || source AS doc_id,
       arg_max(text, doc_id) AS catch_all
FROM documents GROUP BY lang, source""",
    "html_preprocess": f"SELECT page_id, {preprocess('html')} AS text FROM pages",
    "clean_query": with_(
        QUESTIONS, select=f"SELECT id, {cleaned('question')} AS query FROM questions"
    ),
    "nonempty_questions": """SELECT conv_id AS id, arg_max(text, turn) AS question
FROM conversations WHERE coalesce(text, '') <> '' GROUP BY conv_id""",
    "train_questions": """SELECT conv_id || '-' || turn AS id, text AS question
FROM conversations ORDER BY conv_id, turn LIMIT 100""",
    "literal_types_blanked": with_(
        *ANSWERS,
        select=f"""SELECT id, array_to_string({BLANK}, ' ') AS types,
       CASE WHEN category = 'resource' THEN array_to_string(type, ' ') ELSE '' END AS resource_types
FROM answers""",
    ),
    "postings": with_(CORPUS, *postings(), select="SELECT * FROM postings"),
    "term_stats": with_(CORPUS, *postings(), select="SELECT * FROM term_stats"),
    "doc_stats": with_(CORPUS, *postings(), select="SELECT doc_id, dl FROM tokens"),
    "field_stats": with_(
        CORPUS, *postings(), select="SELECT doc_count, round(avgdl, 6) AS avgdl FROM field_stats"
    ),
    "doc_term_freqs": with_(
        CORPUS,
        *postings(),
        select="""SELECT doc_id, string_agg(term || '=' || tf, ' ' ORDER BY term) AS freqs
FROM postings GROUP BY doc_id""",
    ),
    "analyzed_query_terms": with_(
        *SEARCH, select="SELECT id, CAST(pos AS INTEGER) AS pos, term FROM query_terms"
    ),
    "bm25_top10": with_(*SEARCH, hits(10), select="SELECT * FROM hits"),
    "bm25_top10_pruned": with_(*SEARCH, hits(10), select="SELECT * FROM hits"),
    "bm25_top5": with_(*SEARCH, hits(5), select="SELECT * FROM hits"),
    "ltr_first_pass_rankings": with_(*SEARCH, hits(5), select="SELECT * FROM hits"),
    "word_breaks": with_(
        # The same line of words as in the query.
        """lines AS (
  SELECT p_partkey, p_type || '’s U.S. list: ' || p_retailprice::DECIMAL(18, 2) || ', O''' || p_name
    || '; 1,' || lpad((p_size * 17 % 1000)::VARCHAR, 3, '0') || ' units. No.' || p_size || ' a.' || p_brand AS line
  FROM part)""",
        f"tokens AS (SELECT p_partkey, {word_tokens('line')} AS t FROM lines)",
        select="""SELECT p_partkey, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS token
FROM tokens""",
    ),
    "evaluation_counts": recursive(
        with_(
            *ORDERS,
            select="""SELECT (SELECT count(*) FROM hierarchy) AS types,
       (SELECT max(depth) FROM hierarchy)::BIGINT AS max_depth, (SELECT count(*) FROM gold) AS questions,
       (SELECT count(*) FROM system) AS predictions""",
        )
    ),
    "stemmed_postings": with_(*STEMMED, select="SELECT doc_id, term, tf, dl FROM postings"),
    "bm25_stemmed": with_(*STEMMED, hits(10), select="SELECT * FROM hits"),
    "ltr_features_raw": with_(
        *STEMMED,
        hits(5, name="candidates"),
        "raw_counts AS (SELECT id, token AS term, count(*) AS n FROM query_terms GROUP BY id, token)",
        QUERY_FEATURES.replace("query_counts", "raw_counts"),
        QUERY_DOC_FEATURES.replace("query_counts", "raw_counts"),
        ALL_FEATURES,
        select=f"SELECT id, doc_id, {rounded(FEATURES)} FROM features",
    ),
    "bm25_two_fields": TWO_FIELDS,
    "ltr_first_pass_two_fields": TWO_FIELDS,
    "ltr_rerank_members": with_(
        *SEARCH,
        hits(5),
        select="""SELECT id, string_agg(doc_id, ' ' ORDER BY doc_id) AS docs,
       string_agg(rank::VARCHAR, ' ' ORDER BY rank) AS ranks FROM hits GROUP BY id""",
    ),
    "ltr_weights": with_(
        *(ALL_ITEMS if part == FIRST_ITEMS else part for part in RANKER),
        select="\nUNION ALL\n".join(
            f"SELECT '{f}' AS feature, round(w{j}, 9) AS weight FROM weights"
            for j, f in enumerate([*FEATURES, "intercept"], 1)
        ),
    ),
    "ltr_rerank": with_(
        *RERANKED, select="SELECT id, rank, doc_id, round(score, 6) AS score FROM final"
    ),
    "svm_predict": with_(*svm(), select="SELECT * FROM svm_predicted"),
    "svm_weights": with_(*svm(), select="SELECT category, term, round(weight, 4) AS weight FROM svm_weights"),
    "svm_above_majority": with_(
        *svm(),
        select="""SELECT count(*) AS n, sum((p.category = e.category)::INT) > (
  SELECT max(n) FROM (SELECT count(*) AS n FROM every WHERE NOT annotated GROUP BY category)) AS above
FROM every e LEFT JOIN svm_predicted p USING (id) WHERE NOT annotated""",
    ),
    "end_to_end_category_svm": with_(
        *svm(),
        select="""SELECT count(*) AS n,
       round(avg(CASE WHEN p.category = e.category THEN 1.0 ELSE 0.0 END), 3) AS accuracy
FROM every e LEFT JOIN svm_predicted p USING (id)""",
    ),
    "ranking_lists": with_(
        *SEARCH,
        hits(5),
        select="SELECT id, string_agg(doc_id, ' ' ORDER BY rank) AS types FROM hits GROUP BY id",
    ),
    "query_features": with_(
        *SEARCH,
        QUERY_FEATURES,
        select="""SELECT id, query_length, round(query_sum_idf, 6) AS query_sum_idf,
       round(query_max_idf, 6) AS query_max_idf, round(query_avg_idf, 6) AS query_avg_idf
FROM query_features""",
    ),
    "doc_features": with_(
        CORPUS,
        *postings(),
        select="""SELECT doc_id, CAST(coalesce(dl, 0) AS DOUBLE) AS doc_length_catch_all
FROM corpus LEFT JOIN tokens USING (doc_id)""",
    ),
    "query_doc_features": with_(
        ITEMS,
        *item_search("items"),
        QUERY_DOC_FEATURES,
        select="""SELECT id, doc_id, unique_query_terms_in_catch_all, sum_TF_catch_all,
       max_TF_catch_all, round(avg_TF_catch_all, 6) AS avg_TF_catch_all FROM query_doc_features""",
    ),
    "ltr_features": with_(
        ITEMS,
        *item_search("items"),
        QUERY_FEATURES,
        QUERY_DOC_FEATURES,
        ALL_FEATURES,
        select=f"SELECT id, doc_id, {rounded(FEATURES)} FROM features",
    ),
    "ltr_candidates": with_(ITEMS, *item_search("items"), select="SELECT * FROM candidates"),
    "ltr_training_set": training("id IN (SELECT id FROM resource)"),
    "ltr_training_set_doc": training("(id, doc_id) IN (SELECT (id, doc_id) FROM resource)"),
    "term_counts": with_(*COUNTS, select="SELECT * FROM counts"),
    "count_features": with_(
        *COUNTS, select="SELECT c.id, c.term, c.n FROM counts c JOIN vocabulary v ON v.term = c.term"
    ),
    "tfidf_l2": with_(
        *COUNTS,
        """raw AS (
  SELECT id, term, n * (ln((1 + (SELECT count(*) FROM train)) / (1 + df)) + 1) AS w
  FROM counts JOIN vocabulary USING (term))""",
        select="""SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight
FROM raw""",
    ),
    "nb_model": with_(
        *NAIVE_BAYES,
        select="SELECT category, term, round(log_likelihood, 6) AS log_likelihood FROM likelihoods",
    ),
    "nb_predict": with_(*NAIVE_BAYES, select="SELECT * FROM predicted"),
    "nb_accuracy": with_(
        *NAIVE_BAYES,
        select="""SELECT count(*) AS n,
       round(avg(CASE WHEN e.category = p.category THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM every e LEFT JOIN predicted p ON p.id = e.id WHERE NOT e.annotated""",
    ),
    "hierarchy_closure": recursive(with_(HIERARCHY, CLOSURE, select="SELECT * FROM closure")),
    "type_path": recursive(
        with_(
            HIERARCHY,
            CLOSURE,
            select="""SELECT type, depth, string_agg(ancestor, ' ' ORDER BY steps) AS path
FROM hierarchy JOIN closure ON descendant = type GROUP BY type, depth""",
        )
    ),
    "max_depth": with_(HIERARCHY, select="SELECT max(depth) AS max_depth FROM hierarchy"),
    "type_distance": recursive(
        with_(HIERARCHY, CLOSURE, DISTANCES, select="SELECT * FROM distances")
    ),
    "most_specific": recursive(with_(*ORDERS, *GAINS, select="SELECT * FROM specific")),
    "expanded_types": recursive(
        with_(
            HIERARCHY,
            CLOSURE,
            DISTANCES,
            select="""SELECT DISTINCT h.parent AS id, d.type2 AS type
FROM hierarchy h JOIN distances d ON d.type1 = h.type""",
        )
    ),
    "known_gold_types": with_(
        *ANSWERS,
        HIERARCHY,
        known_gold(),
        select="SELECT id, array_to_string(type, ' ') AS types FROM gold",
    ),
    "type_gains": recursive(
        with_(*ORDERS, *GAINS, select="SELECT id, pos, type, round(gain, 6) AS gain FROM gains")
    ),
    "ideal_gains": recursive(
        with_(*ORDERS, *GAINS, select="SELECT id, pos, round(gain, 6) AS gain FROM ideal")
    ),
    "dcg_ndcg": recursive(
        with_(
            *ORDERS,
            *NDCG,
            select="""SELECT id, round(dcg_5, 6) AS dcg_5, round(dcg_10, 6) AS dcg_10,
       round(ideal_5, 6) AS ideal_5, round(ideal_10, 6) AS ideal_10,
       round(ndcg_5, 6) AS ndcg_5, round(ndcg_10, 6) AS ndcg_10 FROM ndcgs""",
        )
    ),
    "question_scores": recursive(with_(*ORDERS, *SCORES, select=ROUNDED_SCORES)),
    "evaluation_summary": recursive(
        with_(
            *ORDERS,
            *SCORES,
            select="""SELECT count(*) AS questions, round(avg(accuracy), 3) AS accuracy,
       count(ndcg_5) AS ranked_questions, round(avg(ndcg_5), 3) AS ndcg_5,
       round(avg(ndcg_10), 3) AS ndcg_10 FROM scores""",
        )
    ),
    "evaluation_diagnostics": recursive(
        with_(
            *ORDERS,
            *SCORES,
            select="""SELECT id, 'empty question' AS kind, '' AS detail FROM answers
WHERE coalesce(question, '') = ''
UNION ALL
SELECT id, 'unknown type', type
FROM (SELECT id, unnest(type) AS type FROM answers
      WHERE category = 'resource' AND coalesce(question, '') <> '')
WHERE type NOT IN (SELECT type FROM hierarchy)
UNION ALL
SELECT id, CASE WHEN predicted_category IS NULL THEN 'no prediction' ELSE 'no gold types' END, ''
FROM ruled WHERE predicted_category IS NULL OR rule = 5""",
        )
    ),
    "category_gated_output": with_(
        *BASELINE, select="SELECT id, category, array_to_string(type, ' ') AS types FROM system"
    ),
    "end_to_end_index": with_(
        ABSTRACT_LINES,
        entity_abstracts("abstract_lines", None),
        """pieces AS (
  SELECT type, ord, abstract AS piece
  FROM (SELECT 'dbo:' || lang AS type, doc_id * 2 AS ord, doc_id FROM documents
        UNION ALL
        SELECT 'dbo:' || lang || ' ' || source, doc_id * 2 + 1, doc_id FROM documents)
       JOIN entity_abstracts ON entity = doc_id::VARCHAR)""",
        type_documents("pieces"),
        *postings("type_docs"),
        select="SELECT * FROM postings",
    ),
    "end_to_end_category": with_(*NAIVE_BAYES, select="SELECT id, category FROM predicted"),
    "end_to_end_ltr": recursive(
        with_(*LTR_RUN, DOCUMENT_TYPES, known_gold("every"), *SCORES, select=ROUNDED_SCORES)
    ),
    "end_to_end_baseline": recursive(
        with_(*BASELINE, DOCUMENT_TYPES, known_gold("every"), *SCORES, select=ROUNDED_SCORES)
    ),
}
