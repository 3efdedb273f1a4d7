"""The same results as plain SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

import re

from ledgertalk.operators import examples as ex
from ledgertalk.plans.queries import (
    MAX_CHECK,
    PACK_LENGTH,
    PACK_SHARDS,
    PART_CHARS,
    RECIPES,
    SUBSET_SIZES,
)

COLUMNS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"

FEED = """
feed_once AS (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN 'C' ELSE '' END
           || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(l_partkey AS VARCHAR) AS StockCode,
         CASE WHEN l_partkey % 97 = 0 THEN NULL
              WHEN l_partkey % 89 = 0 THEN '??'
              WHEN l_linenumber % 5 = 0
                THEN '  ' || p_name || ' ' || CAST(l_partkey AS VARCHAR) || ' '
              ELSE upper(p_name) || ' ' || CAST(l_partkey AS VARCHAR) END AS Description,
         CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN -l_quantity
                   WHEN l_suppkey % 50 = 0 THEN 0
                   WHEN l_suppkey % 50 = 1 THEN NULL
                   ELSE l_quantity END AS INTEGER) AS Quantity,
         CAST(o_orderdate AS VARCHAR) AS InvoiceDate,
         CASE WHEN l_suppkey % 50 = 2 THEN CAST(0 AS DOUBLE)
              WHEN l_suppkey % 50 = 3 THEN -p_retailprice
              ELSE p_retailprice * (1 - l_discount) END AS UnitPrice,
         CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
         n_name AS Country,
         l_orderkey % 20 = 0 AND l_linenumber = 1 AS repeated
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey),
feed AS (
  SELECT {columns} FROM feed_once
  UNION ALL
  SELECT {columns} FROM feed_once WHERE repeated)
""".format(columns=COLUMNS)

EVERY_TURN = (
    "'<|start_header_id|>' || coalesce(role, '') || '<|end_header_id|>\n\n' "
    "|| coalesce(text, '') || '<|eot_id|>'"
)
CANCELLED = "(InvoiceNo LIKE 'C%' OR Quantity <= 0 OR UnitPrice < 0)"
BOUGHT = (
    "(InvoiceNo NOT LIKE 'C%' AND Description IS NOT NULL AND length(Description) > 2 "
    "AND Quantity > 0 AND UnitPrice > 0)"
)
MONEY = "format('{{:,.2f}}', {})"


def total(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(38,8))) AS DOUBLE)"


def hash_key(keys: str, seed: int) -> str:
    return f"md5(concat_ws('#', {keys}, '{seed}'))"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def filled(template: str, **values: str) -> str:
    """``{name}`` slots of a fixed text as a ``||`` chain."""
    pieces = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{"):
            pieces.append(values[piece[1:-1]])
        elif piece:
            pieces.append(quoted(piece))
    return " || ".join(pieces)


def messages(profile: str, question: str, answer: str) -> str:
    return (
        "to_json({'messages': ["
        f"{{'role': 'system', 'content': {quoted(ex.SYSTEM_PROMPT[profile])}}}, "
        f"{{'role': 'user', 'content': {question}}}, "
        f"{{'role': 'assistant', 'content': {answer}}}]}})"
    )


def stages(profile: str) -> list[str]:
    """Common table expressions in dependency order; DuckDB ignores the unused ones."""
    r = RECIPES[profile]
    s = profile == "s"
    unlabelled = (
        "SELECT InvoiceNo, Description, Quantity FROM cancelled WHERE Description IS NOT NULL"
        if s
        else "SELECT InvoiceNo, coalesce(Description, 'Unknown item') AS Description, "
        "coalesce(Quantity, 0) AS Quantity FROM cancelled"
    )
    bought = (
        "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, "
        f"min(Country) AS Country FROM txn WHERE {BOUGHT} GROUP BY ALL"
        if s
        else f"SELECT DISTINCT {COLUMNS} FROM txn WHERE {BOUGHT}"
    )
    tokens = (
        "CAST(ceil(length(json) / 4.0) AS INTEGER)"
        if s
        else r"CAST(len(string_split_regex(json, '\s+')) AS INTEGER)"
    )
    product = dict(
        name="ProductName",
        price=MONEY.format("avg_price"),
        orders="CAST(order_count AS VARCHAR)",
        units="CAST(units_sold AS VARCHAR)",
        countries="CAST(country_count AS VARCHAR)",
    )
    order = dict(
        invoice="InvoiceNo",
        n="CAST(unique_items AS VARCHAR)",
        items="items",
        total=MONEY.format("order_total"),
    )

    def example_table(name: str, source: str, kind: str, question: str, answer: str) -> str:
        return (
            f"{name} AS (SELECT '{kind}' AS example_type, "
            f"CAST({messages(profile, question, answer)} AS VARCHAR) AS json FROM {source})"
        )

    def builders(suffix: str, products: str, order_rows: str, recs: str, cancels: str) -> list[str]:
        return [
            example_table(
                f"ex_product{suffix}",
                products,
                ex.PRODUCT_TYPE[profile],
                filled(ex.PRODUCT_QUESTION[profile], **product),
                filled(ex.PRODUCT_ANSWER[profile], **product),
            ),
            example_table(
                f"ex_order{suffix}",
                order_rows,
                ex.ORDER_TYPE,
                filled(ex.ORDER_QUESTION, **order),
                filled(ex.ORDER_ANSWER[profile], **order),
            ),
            example_table(
                f"ex_rec{suffix}",
                recs,
                ex.REC_TYPE,
                filled(ex.REC_QUESTION, name="src_name"),
                filled(ex.REC_ANSWER[profile], name="src_name", recs="recs"),
            ),
            example_table(
                f"ex_cancel{suffix}",
                cancels,
                ex.CANCEL_TYPE,
                filled(ex.CANCEL_QUESTION, invoice="InvoiceNo"),
                filled(ex.CANCEL_ANSWER[profile], invoice="InvoiceNo", items="items"),
            ),
        ]

    threshold = round(r.train_ratio * 10000)
    return [
        FEED,
        "txn AS (SELECT InvoiceNo, StockCode, trim(Description) AS Description, Quantity, "
        "InvoiceDate, UnitPrice, CustomerID, Country FROM feed "
        "WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL)",
        f"cancelled AS (SELECT * FROM txn WHERE {CANCELLED})",
        f"bought AS ({bought})",
        "description_counts AS (SELECT StockCode, Description, CAST(count(*) AS BIGINT) AS count "
        "FROM bought GROUP BY ALL)",
        "names AS (SELECT StockCode, Description AS ProductName FROM (SELECT *, row_number() OVER "
        "(PARTITION BY StockCode ORDER BY count DESC, Description) AS rn FROM description_counts) "
        "WHERE rn = 1)",
        "lines AS (SELECT b.StockCode, b.InvoiceNo, b.Quantity, b.InvoiceDate, b.UnitPrice, "
        "b.CustomerID, b.Country, n.ProductName, b.Quantity * b.UnitPrice AS LineTotal "
        "FROM bought b JOIN names n ON b.StockCode = n.StockCode)",
        "product_stats AS (SELECT StockCode, ProductName, "
        "CAST(count(DISTINCT InvoiceNo) AS BIGINT) AS order_count, "
        "CAST(sum(Quantity) AS BIGINT) AS units_sold, "
        f"{total('UnitPrice')} / count(*) AS avg_price, "
        "CAST(count(DISTINCT Country) AS BIGINT) AS country_count FROM lines GROUP BY ALL)",
        "product_ranking AS (SELECT * FROM product_stats "
        f"ORDER BY order_count DESC, StockCode LIMIT {r.max_products})",
        "item_rows AS (SELECT *, row_number() OVER (PARTITION BY InvoiceNo, Country "
        "ORDER BY StockCode, Quantity, UnitPrice) AS rn FROM (SELECT *, ProductName || ' x' || "
        f"CAST(Quantity AS VARCHAR) || ' at £' || {MONEY.format('UnitPrice')} AS item FROM lines))",
        "order_base AS (SELECT InvoiceNo, Country, "
        f"string_agg(item, '; ' ORDER BY rn) FILTER (WHERE rn <= {r.items_per_order}) AS items, "
        f"{total('LineTotal')} AS order_total, "
        "CAST(count(DISTINCT StockCode) AS BIGINT) AS unique_items"
        + (", min(InvoiceDate) AS invoice_date " if s else " ")
        + "FROM item_rows GROUP BY InvoiceNo, Country)",
        "order_sample AS (SELECT * FROM order_base ORDER BY "
        f"{hash_key('InvoiceNo, Country', r.order_seed)}, InvoiceNo, Country LIMIT {r.max_orders})",
        f"cancel_items AS ({unlabelled})",
        "cancel_rows AS (SELECT *, row_number() OVER (PARTITION BY InvoiceNo ORDER BY Description) "
        "AS rn FROM cancel_items)",
        "cancellation_base AS (SELECT InvoiceNo, string_agg(Description, '; ' ORDER BY rn) "
        f"FILTER (WHERE rn <= {r.items_per_cancellation}) AS items, "
        "CAST(sum(Quantity) AS BIGINT) AS net_quantity FROM cancel_rows GROUP BY InvoiceNo)",
        "cancel_sample AS (SELECT * FROM cancellation_base ORDER BY "
        f"{hash_key('InvoiceNo', r.cancel_seed)}, InvoiceNo LIMIT {r.max_cancellations})",
        "basket_sizes AS (SELECT InvoiceNo, CAST(count(DISTINCT StockCode) AS BIGINT) AS basket_size "
        "FROM lines GROUP BY InvoiceNo)",
        "basket_items AS (SELECT DISTINCT l.InvoiceNo, l.StockCode, l.ProductName, "
        "CAST(z.basket_size AS INTEGER) AS basket_size FROM lines l JOIN basket_sizes z "
        f"ON l.InvoiceNo = z.InvoiceNo WHERE z.basket_size <= {r.basket_cap})",
        "pairs AS (SELECT a.InvoiceNo, a.StockCode AS a_code, a.ProductName AS a_name, "
        "b.StockCode AS b_code, b.ProductName AS b_name FROM basket_items a JOIN basket_items b "
        "ON a.InvoiceNo = b.InvoiceNo AND a.StockCode < b.StockCode)",
        "directed AS (SELECT InvoiceNo, a_code AS src_code, a_name AS src_name, b_name AS rec_name "
        "FROM pairs UNION ALL SELECT InvoiceNo, b_code, b_name, a_name FROM pairs)",
        "pair_counts AS (SELECT src_code, src_name, rec_name, CAST(count(*) AS BIGINT) AS score "
        "FROM directed GROUP BY ALL)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY src_code ORDER BY score DESC, rec_name) "
        "AS rn FROM pair_counts)",
        "top_recs AS (SELECT src_code, src_name, string_agg(rec_name, ', ' ORDER BY rn) AS recs "
        f"FROM ranked WHERE rn <= {r.recs_per_product} GROUP BY ALL HAVING count(*) >= 2)",
        "rec_sample AS (SELECT * FROM top_recs ORDER BY "
        f"{hash_key('src_code', r.rec_seed)}, src_code LIMIT {r.max_recs})",
        *builders("", "product_stats", "order_base", "top_recs", "cancellation_base"),
        *builders("_run", "product_ranking", "order_sample", "rec_sample", "cancel_sample"),
        "examples AS (SELECT min(example_type) AS example_type, json FROM ("
        "SELECT * FROM ex_product_run UNION ALL SELECT * FROM ex_order_run UNION ALL "
        "SELECT * FROM ex_rec_run UNION ALL SELECT * FROM ex_cancel_run) GROUP BY json)",
        "split_examples AS (SELECT example_type, json, CASE WHEN CAST('0x' || "
        f"substr(md5(json || '#{r.seed}'), 1, 8) AS BIGINT) % 10000 < {threshold} "
        "THEN 'train' ELSE 'eval' END AS split FROM examples)",
        f"lengths AS (SELECT split, example_type, {tokens} AS approx_tokens FROM split_examples)",
        "split_counts AS (SELECT split, example_type, CAST(count(*) AS BIGINT) AS count "
        "FROM split_examples GROUP BY ALL)",
        "country_counts AS (SELECT Country, CAST(count(*) AS BIGINT) AS line_count FROM lines "
        "GROUP BY Country)",
    ]


def over_feed(profile: str, body: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in stages(profile)) + "\n" + body


BOTH = {
    "normalize_txn": "SELECT * FROM txn",
    "purchases": "SELECT * FROM bought",
    "line_items": "SELECT * FROM lines",
    "product_stats": "SELECT * FROM product_stats",
    "product_ranking": "SELECT * FROM product_ranking",
    "order_base": "SELECT * FROM order_base",
    "order_sample": "SELECT * FROM order_sample",
    "cancellation_base": "SELECT * FROM cancellation_base",
    "cancel_sample": "SELECT * FROM cancel_sample",
    "basket_items": "SELECT * FROM basket_items",
    "top_recs": "SELECT * FROM top_recs",
    "rec_sample": "SELECT * FROM rec_sample",
    "ex_product": "SELECT * FROM ex_product",
    "ex_order": "SELECT * FROM ex_order",
    "ex_rec": "SELECT * FROM ex_rec",
    "ex_cancel": "SELECT * FROM ex_cancel",
    "sft_examples": "SELECT * FROM examples",
    "train_eval_split": "SELECT * FROM split_examples",
    "token_lengths": "SELECT example_type, approx_tokens FROM lengths",
    "split_counts": "SELECT * FROM split_counts",
}

SUMMARY = """
SELECT 'raw_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM txn
UNION ALL SELECT 'clean_purchase_rows', CAST(count(*) AS BIGINT) FROM bought
UNION ALL SELECT '{cancelled}', CAST(count(*) AS BIGINT) FROM cancelled
"""

ONLY_N = {
    "cancellations": "SELECT * FROM cancelled",
    "txn_class_counts": f"""
SELECT CASE WHEN {CANCELLED} THEN 'cancellation' WHEN {BOUGHT} THEN 'purchase' ELSE 'neither' END
         AS txn_class,
       CAST(count(*) AS BIGINT) AS line_count
FROM txn GROUP BY ALL""",
    "description_counts": "SELECT * FROM description_counts",
    "product_names": "SELECT * FROM names",
    "basket_sizes": "SELECT * FROM basket_sizes",
    "copurchase_pairs": "SELECT * FROM pairs",
    "directed_pairs": "SELECT * FROM directed",
    "pair_counts": "SELECT * FROM pair_counts",
    "country_counts": "SELECT * FROM country_counts",
    "top_countries": "SELECT * FROM country_counts ORDER BY line_count DESC, Country LIMIT 15",
    "top15_products": "SELECT StockCode, ProductName, order_count FROM product_stats "
    "ORDER BY order_count DESC, StockCode LIMIT 15",
    "cleaning_summary": SUMMARY.format(cancelled="cancel_or_return_rows")
    + """
UNION ALL SELECT 'total_sft_examples', CAST(count(*) AS BIGINT) FROM split_examples
UNION ALL SELECT 'train_examples', CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT)
  FROM split_examples
UNION ALL SELECT 'eval_examples', CAST(count(*) FILTER (WHERE split = 'eval') AS BIGINT)
  FROM split_examples""",
    "split_pivot": """
SELECT example_type,
       CAST(coalesce(sum(count) FILTER (WHERE split = 'eval'), 0) AS BIGINT) AS eval,
       CAST(coalesce(sum(count) FILTER (WHERE split = 'train'), 0) AS BIGINT) AS train
FROM split_counts GROUP BY example_type""",
    "token_describe": """
SELECT n AS count, total / n AS mean,
       sqrt(CAST(n * squares - total * total AS DOUBLE) / (CAST(n AS DOUBLE) * (n - 1))) AS std,
       "min", p25, p50, p75, "max"
FROM (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(approx_tokens) AS HUGEINT) AS total,
             CAST(sum(CAST(approx_tokens AS BIGINT) * approx_tokens) AS HUGEINT) AS squares,
             min(approx_tokens) AS "min", quantile_cont(approx_tokens, 0.25) AS p25,
             quantile_cont(approx_tokens, 0.5) AS p50, quantile_cont(approx_tokens, 0.75) AS p75,
             max(approx_tokens) AS "max"
      FROM lengths)""",
    "token_hist50": """
SELECT CAST(b.bin AS INTEGER) AS bin, e.low + b.bin * (e.high - e.low) / 50.0::DOUBLE AS bin_start,
       CAST(count(l.approx_tokens) AS BIGINT) AS count
FROM range(50) AS b(bin)
CROSS JOIN (SELECT min(approx_tokens) AS low, max(approx_tokens) AS high FROM lengths) e
LEFT JOIN lengths l
  ON CASE WHEN e.high = e.low THEN 25
          ELSE least((l.approx_tokens - e.low) * 50 // (e.high - e.low), 49) END = b.bin
GROUP BY b.bin, e.low, e.high""",
    "csv_roundtrip": "SELECT * FROM txn",
}

ONLY_S = {
    "cleaning_summary_s": SUMMARY.format(cancelled="cancellation_or_invalid_rows"),
    "token_summary": """
SELECT split, CAST(count(*) AS BIGINT) AS sample_count, min(approx_tokens) AS min_tokens,
       quantile_disc(approx_tokens, 0.25) AS p25_tokens,
       quantile_disc(approx_tokens, 0.5) AS median_tokens,
       quantile_disc(approx_tokens, 0.75) AS p75_tokens, max(approx_tokens) AS max_tokens
FROM lengths GROUP BY split""",
    "token_hist": """
SELECT split,
       CASE WHEN approx_tokens < 100 THEN '000-099' WHEN approx_tokens < 200 THEN '100-199'
            WHEN approx_tokens < 300 THEN '200-299' WHEN approx_tokens < 400 THEN '300-399'
            WHEN approx_tokens < 600 THEN '400-599' ELSE '600+' END AS token_bucket,
       CAST(count(*) AS BIGINT) AS count
FROM lengths GROUP BY ALL""",
    "top_products": f"""
SELECT StockCode, ProductName, order_count, units_sold, {MONEY.format('round(avg_price, 2)')} AS avg_price
FROM product_stats ORDER BY order_count DESC, StockCode LIMIT 25""",
    "sample_preview": f"SELECT json FROM examples ORDER BY {hash_key('json', 42)}, json LIMIT 20",
}

EXCHANGES = """
WITH exchanges AS (
  SELECT u.conv_id, u.turn, s.text AS system, u.text AS question, a.text AS answer
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system'
  WHERE u.role = 'user'),
chats AS (
  SELECT *, CAST(CASE WHEN system IS NULL
    THEN to_json({'messages': [{'role': 'user', 'content': question},
                               {'role': 'assistant', 'content': answer}]})
    ELSE to_json({'messages': [{'role': 'system', 'content': system},
                               {'role': 'user', 'content': question},
                               {'role': 'assistant', 'content': answer}]}) END AS VARCHAR) AS json
  FROM exchanges),
"""

DAMAGED = EXCHANGES + """
lines AS (
  SELECT conv_id, turn, CASE conv_id % 7
    WHEN 1 THEN substr(json, 1, length(json) - 3)
    WHEN 2 THEN '{"x":1}'
    WHEN 3 THEN '{"messages":"none"}'
    WHEN 4 THEN CAST(CASE WHEN system IS NULL
      THEN to_json({'messages': [{'role': 'assistant', 'content': answer},
                                 {'role': 'user', 'content': question}]})
      ELSE to_json({'messages': [{'role': 'assistant', 'content': answer},
                                 {'role': 'user', 'content': question},
                                 {'role': 'system', 'content': system}]}) END AS VARCHAR)
    WHEN 5 THEN CAST(CASE WHEN system IS NULL
      THEN to_json({'messages': [{'role': 'user', 'content': ''},
                                 {'role': 'assistant', 'content': answer}]})
      ELSE to_json({'messages': [{'role': 'system', 'content': system},
                                 {'role': 'user', 'content': ''},
                                 {'role': 'assistant', 'content': answer}]}) END AS VARCHAR)
    ELSE json END AS line
  FROM chats),
parsed AS (
  SELECT conv_id, turn, line, CASE WHEN json_valid(line) THEN line END AS good FROM lines),
checked AS (
  SELECT conv_id, turn, line, CASE
    WHEN good IS NULL THEN 'not_json'
    WHEN coalesce(json_type(good, '$.messages'), '') <> 'ARRAY' THEN 'no_message_list'
    WHEN json_array_length(good, '$.messages') <> 3 THEN 'message_count'
    WHEN (good ->> '$.messages[0].role') IS DISTINCT FROM 'system'
      OR (good ->> '$.messages[1].role') IS DISTINCT FROM 'user'
      OR (good ->> '$.messages[2].role') IS DISTINCT FROM 'assistant' THEN 'role_order'
    WHEN coalesce(length(good ->> '$.messages[0].content'), 0) = 0
      OR coalesce(length(good ->> '$.messages[1].content'), 0) = 0
      OR coalesce(length(good ->> '$.messages[2].content'), 0) = 0 THEN 'empty_content'
    END AS fault
  FROM parsed)
"""

FAULT_LINES = DAMAGED + """, placed AS (
  SELECT conv_id % 4 AS shard, line, fault, CASE WHEN turn % 3 = 2 THEN '' ELSE line END AS text,
         row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id, turn) AS line_no
  FROM checked)
"""

SPLIT_LABEL = "CASE WHEN CAST('0x' || substr(md5({key} || '#42'), 1, 8) AS BIGINT) % 10000 < 9000 THEN '{train}' ELSE '{eval}' END"


def turn_text(role: str, content: str) -> str:
    return f"'<|start_header_id|>{role}<|end_header_id|>\n\n' || {content} || '<|eot_id|>'"


DOC_LENGTHS = (
    "WITH docs AS (SELECT doc_id, CAST(ceil(length(text) / 4.0) AS INTEGER) AS approx_tokens "
    "FROM documents)"
)
SYSTEM_PART = f"CASE WHEN system IS NULL THEN '' ELSE {turn_text('system', 'system')} END"
ASKED = f"{SYSTEM_PART} || {turn_text('user', 'question')}"

OTHER = {
    "sft_validate": DAMAGED
    + "SELECT coalesce(fault, 'ok') AS result, CAST(count(*) AS BIGINT) AS line_count "
    "FROM checked GROUP BY ALL",
    "sft_violations": DAMAGED + "SELECT conv_id, turn, fault FROM checked WHERE fault IS NOT NULL",
    "conv_role_check": """
WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place,
         max(CASE WHEN role = 'system' AND turn = 0 THEN 1 ELSE 0 END)
           OVER (PARTITION BY conv_id) AS opened
  FROM conversations)
SELECT conv_id, CAST(count(*) AS BIGINT) AS turn_count, bool_or(role = 'system') AS has_system,
       bool_and(turn = place) AS numbered,
       bool_and(role = CASE WHEN opened = 1 AND turn = 0 THEN 'system'
                            WHEN (turn - opened) % 2 = 0 THEN 'user' ELSE 'assistant' END) AS roles_ok,
       bool_and(length(text) > 0) AS content_ok
FROM placed GROUP BY conv_id""",
    "chat_render": EXCHANGES.rstrip().rstrip(",")
    + f" SELECT conv_id, turn, {ASKED} || {turn_text('assistant', 'answer')} AS text FROM chats",
    "chat_prompt": EXCHANGES.rstrip().rstrip(",")
    + f" SELECT conv_id, turn, {ASKED} || '<|start_header_id|>assistant<|end_header_id|>\n\n' "
    "AS prompt FROM chats",
    "turn_text": f"SELECT conv_id, turn, {EVERY_TURN} AS text FROM conversations",
    "turn_prompt": f"SELECT conv_id, turn, {EVERY_TURN} || '<|start_header_id|>assistant"
    "<|end_header_id|>\n\n' AS prompt FROM conversations WHERE role = 'user'",
    "jsonl_roundtrip": EXCHANGES.rstrip().rstrip(",")
    + " SELECT json, "
    + SPLIT_LABEL.format(key="json", train="train", eval="validation")
    + " AS split FROM chats",
    "response_compare": """
WITH firsts AS (
  SELECT conv_id, min(turn) FILTER (WHERE role = 'user') AS asked,
         min(turn) FILTER (WHERE role = 'assistant') AS first_reply,
         max(turn) FILTER (WHERE role = 'assistant') AS last_reply
  FROM conversations GROUP BY conv_id),
replies AS (
  SELECT split_part(p.text, ' ', 1) AS prompt, b.text AS base, t.text AS tuned
  FROM firsts f
  JOIN conversations p ON p.conv_id = f.conv_id AND p.turn = f.asked
  JOIN conversations b ON b.conv_id = f.conv_id AND b.turn = f.first_reply
  JOIN conversations t ON t.conv_id = f.conv_id AND t.turn = f.last_reply),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY md5(base), base) AS nth_base,
         row_number() OVER (PARTITION BY prompt ORDER BY md5(tuned), tuned) AS nth_tuned
  FROM replies)
SELECT x.prompt, x.base AS base_response, y.tuned AS fine_tuned_response,
       CAST(length(x.base) AS INTEGER) AS base_chars,
       CAST(length(y.tuned) AS INTEGER) AS fine_tuned_chars, x.base = y.tuned AS same_text
FROM numbered x JOIN numbered y ON x.prompt = y.prompt AND x.nth_base = y.nth_tuned""",
    "sft_fault_lines": FAULT_LINES
    + "SELECT shard, line_no, line, fault FROM placed WHERE text <> '' AND fault IS NOT NULL",
    "sft_max_check": FAULT_LINES
    + "SELECT coalesce(fault, 'ok') AS result, CAST(count(*) AS BIGINT) AS line_count FROM (SELECT *, "
    "row_number() OVER (PARTITION BY shard ORDER BY line_no) AS nth FROM placed WHERE text <> '') "
    f"WHERE nth <= {MAX_CHECK} GROUP BY ALL",
    "conversation_text": f"""
WITH pieces AS (SELECT conv_id, turn, {EVERY_TURN} AS piece FROM conversations),
placed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, piece
                                     ROWS UNBOUNDED PRECEDING) - length(piece) AS begins FROM pieces)
SELECT conv_id, CAST(begins // {PART_CHARS} AS BIGINT) AS part, CAST(min(begins) AS BIGINT) AS start,
       string_agg(piece, '' ORDER BY begins) AS text
FROM placed GROUP BY conv_id, begins // {PART_CHARS}""",
    "csv_scan": "WITH "
    + FEED
    + "SELECT InvoiceNo, StockCode, trim(Description) AS Description, "
    "CAST(Quantity AS VARCHAR) AS Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM feed",
    "loss_curve": "SELECT event_id AS step, value AS loss FROM events "
    "WHERE event_type = 'purchase' AND value IS NOT NULL ORDER BY step",
    "train_subset": DOC_LENGTHS
    + ", labelled AS (SELECT doc_id, approx_tokens, "
    + SPLIT_LABEL.format(key="CAST(doc_id AS VARCHAR)", train="train", eval="eval")
    + " AS split FROM docs), placed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY "
    + hash_key("CAST(doc_id AS VARCHAR)", 42)
    + ", doc_id) AS rn FROM labelled) SELECT doc_id, approx_tokens, split FROM placed "
    + "WHERE rn <= CASE split "
    + " ".join(f"WHEN '{split}' THEN {n}" for split, n in SUBSET_SIZES.items())
    + " END",
    "seq_overflow": DOC_LENGTHS
    + f" SELECT doc_id, approx_tokens, approx_tokens > {PACK_LENGTH} AS overflows FROM docs",
    "seq_pack": DOC_LENGTHS
    + f""", hashed AS (
  SELECT *, {hash_key('CAST(doc_id AS VARCHAR)', 42)} AS digest FROM docs),
sharded AS (
  SELECT *, CAST(CAST('0x' || substr(digest, 1, 8) AS BIGINT) % {PACK_SHARDS} AS INTEGER) AS shard
  FROM hashed),
laid AS (
  SELECT *, sum(approx_tokens) OVER (PARTITION BY shard ORDER BY digest, doc_id
                                     ROWS UNBOUNDED PRECEDING) AS stop FROM sharded)
SELECT doc_id, approx_tokens, shard, CAST(stop - approx_tokens AS BIGINT) AS start,
       CAST((stop - approx_tokens) // {PACK_LENGTH} AS BIGINT) AS pack_id,
       CAST(floor((stop - 1) / {PACK_LENGTH}.0) AS BIGINT)
         > CAST((stop - approx_tokens) // {PACK_LENGTH} AS BIGINT) AS spills
FROM laid""",
}


def all_sql() -> dict[str, str]:
    found = {}
    for name, body in BOTH.items():
        found[name] = over_feed("n", body)
        found[f"{name}_s"] = over_feed("s", body)
    found.update({name: over_feed("n", body) for name, body in ONLY_N.items()})
    found.update({name: over_feed("s", body) for name, body in ONLY_S.items()})
    found.update(OTHER)
    found.update(
        {
            "built_line_items": found["line_items"],
            "built_typed_examples": found["sft_examples"],
            "built_jsonl": over_feed("n", "SELECT split, json FROM split_examples"),
            "built_split_counts": found["split_counts"],
            "built_token_lengths": found["token_lengths"],
            "built_ranking": found["product_ranking"],
            "built_jsonl_s": over_feed("s", "SELECT split, json FROM split_examples"),
            "built_token_summary_s": found["token_summary"],
        }
    )
    return found
