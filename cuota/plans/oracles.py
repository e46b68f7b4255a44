"""ANSI SQL that gives the result of each registered query on the same tables, run by an independent engine."""

from __future__ import annotations

# Shared sub-queries. Amounts have two decimals and are added as DECIMAL, then cast back.
_CREDIT_UNION = """
cr AS (
  SELECT CAST(l_shipdate AS DATE) AS fecha, CAST(s_nationkey AS BIGINT) AS codigo_entidad,
         lower(p_type) AS actividad_destino_vs2,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS cartera_vencida,
         CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS cartera_vigente
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
)"""

_SUCCESSOR = """CASE codigo_entidad WHEN 3 THEN 1001 WHEN 7 THEN 1001 WHEN 11 THEN 12 WHEN 18 THEN 1002
       ELSE codigo_entidad END"""

_CREDIT = _CREDIT_UNION + f""",
csr AS (SELECT fecha, {_SUCCESSOR} AS codigo, actividad_destino_vs2, cartera_vencida, cartera_vigente FROM cr),
csc AS (
  SELECT fecha, codigo, actividad_destino_vs2,
         coalesce(CAST(sum(CAST(cartera_vigente AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS cartera_vigente,
         coalesce(CAST(sum(CAST(cartera_vencida AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS cartera_vencida
  FROM csr GROUP BY 1, 2, 3
),
credito AS (
  SELECT fecha, coalesce(n_name, 'ERROR') AS entidad, actividad_destino_vs2 AS actividad, cartera_vigente,
         cartera_vencida, cartera_vigente + cartera_vencida AS cartera_total
  FROM csc LEFT JOIN nation ON codigo = n_nationkey
)"""

_CARDS = f"""
tci AS (
  SELECT CAST(o_orderdate AS DATE) AS fecha, CAST(c_nationkey AS BIGINT) AS codigo_entidad,
         lower(o_orderpriority) AS clasificacion, o_totalprice AS total
  FROM orders JOIN customer ON o_custkey = c_custkey
),
tcc AS (
  SELECT fecha, {_SUCCESSOR} AS codigo, clasificacion,
         coalesce(CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS total
  FROM tci GROUP BY 1, 2, 3
),
tarjetas AS (
  SELECT fecha, coalesce(n_name, 'ERROR') AS entidad, upper(clasificacion) AS clasificacion, total
  FROM tcc LEFT JOIN nation ON codigo = n_nationkey
)"""

_INCOME = f"""
eri AS (
  SELECT CAST(ts AS DATE) AS fecha, user_id % 25 AS codigo_entidad, event_type AS sub_rubro, value AS importe,
         props AS reporte
  FROM events
),
erc AS (
  SELECT fecha, {_SUCCESSOR} AS codigo, sub_rubro,
         coalesce(CAST(sum(CAST(importe AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS importe, min(reporte) AS reporte
  FROM eri GROUP BY 1, 2, 3
),
resultados AS (
  SELECT fecha, coalesce(n_name, 'ERROR') AS entidad, sub_rubro, importe, reporte
  FROM erc LEFT JOIN nation ON codigo = n_nationkey
)"""

_CLASSIFIED = _INCOME + """,
idx (sub_rubro_base, clasificacion, rubro, sub_rubro_reporte) AS (
  VALUES ('click', 'INGRESOS', 'COMISIONES', 'Clics'), ('view', 'INGRESOS', 'INTERESES', 'Vistas'),
         ('view', 'EGRESOS', 'INTERESES', 'Vistas pagadas'), ('purchase', 'EGRESOS', 'GASTOS', 'Compras')
),
clasificados AS (
  SELECT fecha, entidad, clasificacion, rubro, sub_rubro_reporte, sub_rubro, reporte, importe
  FROM resultados LEFT JOIN idx ON sub_rubro = sub_rubro_base
)"""

_FACTS = """
hechos AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha, n_name AS banco, o_orderpriority AS producto,
         CAST(o_totalprice AS DECIMAL(18,2)) AS monto
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE), n_name, p_type, CAST(l_extendedprice AS DECIMAL(18,2))
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
       JOIN nation ON s_nationkey = n_nationkey
)"""


def _share(since: str, until: str) -> str:
    return _FACTS + f""",
base AS (
  SELECT fecha AS mes, banco, producto, sum(monto) AS m FROM hechos
  WHERE fecha BETWEEN {since} AND {until} GROUP BY 1, 2, 3
),
tot AS (SELECT mes, sum(m) AS t FROM base GROUP BY 1),
cuota AS (
  SELECT mes, banco, producto, CAST(m AS DOUBLE) AS monto_mes, CAST(t AS DOUBLE) AS total_mes,
         CASE WHEN t <> 0 THEN CAST(m AS DOUBLE) / CAST(t AS DOUBLE) END AS share_mes
  FROM base JOIN tot USING (mes)
)"""


_WINDOW = _share("DATE '1999-04-01'", "DATE '2001-03-01'")

_MIX = _share("DATE '2001-03-01'", "DATE '2001-03-01'") + """,
bancos AS (SELECT banco, CAST(sum(CAST(monto_mes AS DECIMAL(28,2))) AS DOUBLE) AS total_banco FROM cuota GROUP BY 1),
mezcla AS (
  SELECT mes, banco, producto, monto_mes, total_mes, share_mes, total_banco,
         CASE WHEN total_banco > 0 THEN monto_mes / total_banco END AS share_producto
  FROM cuota JOIN bancos USING (banco)
)"""

_PRODUCTS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "ECONOMY", "LARGE", "MEDIUM", "PROMO",
             "SMALL", "STANDARD")

# Navigation links of each page in order, and the search methods over them.
_LINKS = """
nav AS (
  SELECT page_id, html, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
         regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS texts,
         lower(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) AS head
  FROM pages
),
a AS (
  SELECT page_id, head, lower(array_to_string(texts, '')) AS all_text, array_to_string(texts, '') AS title,
         unnest(hrefs) AS href, unnest(texts) AS text, generate_subscripts(hrefs, 1) AS pos
  FROM nav
),
fits AS (
  SELECT *, lower(href) LIKE '%e%' AND lower(href) NOT LIKE '%de%' AS wanted, regexp_matches(lower(text), '(e|i)n') AS button
  FROM a
),
heads AS (
  SELECT page_id, min(pos) AS pos,
         CASE WHEN any_value(head) LIKE '%de%' THEN 'tabla_a' WHEN any_value(head) LIKE '%er%' THEN 'tabla_b' END AS type
  FROM fits WHERE wanted AND button GROUP BY page_id
),
typed AS (
  SELECT *, CASE WHEN lower(text) LIKE '%ll%' OR lower(text) LIKE '%qu%' THEN 'tabla_a'
                 WHEN lower(text) LIKE '%ing%' OR lower(text) LIKE '%ei%' THEN 'tabla_b'
                 WHEN all_text LIKE '%ll%' OR all_text LIKE '%qu%' THEN 'tabla_a'
                 WHEN all_text LIKE '%ing%' OR all_text LIKE '%ei%' THEN 'tabla_b' END AS type
  FROM fits WHERE wanted AND button
),
cand AS (
  SELECT page_id, 1 AS r, pos, href, title AS text, CAST(NULL AS VARCHAR) AS type FROM fits WHERE pos = 1 AND wanted
  UNION ALL
  SELECT f.page_id, 2, f.pos, href, CASE type WHEN 'tabla_a' THEN 'Tabla A' ELSE 'Tabla B' END, type
  FROM heads h JOIN fits f ON h.page_id = f.page_id AND h.pos = f.pos WHERE type IS NOT NULL
  UNION ALL
  SELECT page_id, 3, pos, href, CASE type WHEN 'tabla_a' THEN 'Tabla A' ELSE 'Tabla B' END, type
  FROM typed WHERE type IS NOT NULL
  UNION ALL
  SELECT page_id, 4, pos, href, text, NULL FROM fits WHERE wanted
),
found AS (
  SELECT page_id, r, pos, 'https://boletin.example' || href AS url, text, type,
         CASE r WHEN 1 THEN 'structured_section' WHEN 2 THEN 'section_header' WHEN 3 THEN 'context_analysis'
                ELSE 'direct_link' END AS method
  FROM cand
),
counts AS (
  SELECT page_id, count(DISTINCT url) FILTER (r <= 2) AS n2, count(DISTINCT url) FILTER (r <= 3) AS n3
  FROM found GROUP BY page_id
),
links AS (
  SELECT page_id, url, text, type, method, r, pos FROM found JOIN counts USING (page_id)
  WHERE r <= 2 OR (r = 3 AND n2 < 2) OR (r = 4 AND n3 < 2)
  QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY r, pos) = 1
),
cats AS (
  SELECT *, CASE WHEN type IS NOT NULL THEN type
                 WHEN lower(text) LIKE '%tabla a%' OR lower(text) LIKE '%en%' OR lower(text) LIKE '%qu%'
                      OR lower(url) LIKE '%la%' THEN 'tabla_a'
                 WHEN lower(text) LIKE '%tabla b%' OR lower(text) LIKE '%re%' OR lower(text) LIKE '%in%'
                      OR lower(url) LIKE '%th%' THEN 'tabla_b'
                 ELSE 'otros' END AS category
  FROM links
)"""

_CHOSEN = """
s AS (
  SELECT o_custkey AS file, o_orderpriority || ' - ' || o_orderstatus AS sheet, o_orderkey AS pos,
         lower(replace(replace(o_orderpriority || ' ' || o_orderstatus, '-', ' '), '   ', ' ')) AS t FROM orders
),
m AS (
  SELECT *, 'Urgente' AS target FROM s WHERE t LIKE '%urgent%'
  UNION ALL SELECT *, 'Alto F' FROM s WHERE t LIKE '%high%' AND t LIKE '% f%'
  UNION ALL SELECT *, 'Bajo' FROM s WHERE t LIKE '%low%' AND t LIKE '%5%'
),
chosen AS (SELECT file, target, sheet FROM m QUALIFY row_number() OVER (PARTITION BY file, target ORDER BY pos) = 1)"""

_FOLDED = "regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g')"


def oracles() -> dict[str, str]:
    """SQL by query name."""
    return {
        "trailing_share": f"WITH {_WINDOW} SELECT * FROM cuota",
        "staging_typed": """
            SELECT CAST(l_shipdate AS DATE) AS fecha,
                   CASE WHEN l_linenumber IN (1, 3) THEN NULL ELSE l_suppkey END AS codigo_entidad,
                   CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS sub_rubro,
                   CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END AS importe
            FROM lineitem""",
        "staging_rejects": """
            SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_linenumber IN (1, 3) THEN 'codigo_entidad' END, CASE WHEN l_linestatus = 'O' THEN 'importe' END) AS rechazadas
            FROM lineitem WHERE l_linenumber IN (1, 3) OR l_linestatus = 'O'""",
        "union_institutions": f"WITH {_CREDIT_UNION} SELECT * FROM cr",
        "entity_remap": f"""WITH {_CREDIT_UNION}
            SELECT fecha, CAST({_SUCCESSOR} AS BIGINT) AS codigo_entidad, actividad_destino_vs2 FROM cr""",
        "entity_name": f"""WITH {_CREDIT_UNION}, r AS (SELECT fecha, CAST({_SUCCESSOR} AS BIGINT) AS codigo FROM cr)
            SELECT fecha, codigo AS codigo_entidad, coalesce(n_name, 'ERROR') AS entidad
            FROM r LEFT JOIN nation ON codigo = n_nationkey""",
        "credit_consolidated": f"WITH {_CREDIT} SELECT * FROM credito",
        "card_consolidated": f"WITH {_CARDS} SELECT * FROM tarjetas",
        "income_consolidated": f"WITH {_INCOME} SELECT * FROM resultados",
        "income_classified": f"WITH {_CLASSIFIED} SELECT * FROM clasificados",
        "index_repeated_keys": """SELECT event_type AS sub_rubro_base, count(*) AS veces FROM events GROUP BY 1
            HAVING count(*) > 1""",
        "table_profile": f"""WITH {_CREDIT}, {_CARDS}, {_CLASSIFIED}
            SELECT 'credito_sector' AS tabla, count(*) AS filas, min(fecha) AS min_fecha, max(fecha) AS max_fecha
            FROM credito
            UNION ALL SELECT 'tarjetas', count(*), min(fecha), max(fecha) FROM tarjetas
            UNION ALL SELECT 'estado_resultados', count(*), min(fecha), max(fecha) FROM clasificados""",
        "monthly_credit_share": f"""WITH {_CREDIT}, s AS (
              SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes, entidad,
                     sum(CAST(cartera_total AS DECIMAL(28,2))) AS m, sum(CAST(cartera_vencida AS DECIMAL(28,2))) AS v
              FROM credito WHERE upper(actividad) = 'ECONOMY' GROUP BY 1, 2)
            SELECT mes, entidad, CAST(m AS DOUBLE) AS monto, CAST(v AS DOUBLE) AS vencida,
                   CAST(m AS DOUBLE) / nullif(CAST(sum(m) OVER (PARTITION BY mes) AS DOUBLE), 0) AS share FROM s""",
        "delinquency": f"""WITH {_CREDIT}, s AS (
              SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes, entidad,
                     CAST(sum(CAST(cartera_total AS DECIMAL(28,2))) AS DOUBLE) AS monto,
                     CAST(sum(CAST(cartera_vencida AS DECIMAL(28,2))) AS DOUBLE) AS vencida
              FROM credito WHERE upper(actividad) = 'PROMO' GROUP BY 1, 2)
            SELECT mes, entidad, monto, vencida, CASE WHEN monto > 0 THEN vencida / monto END AS morosidad FROM s""",
        "monthly_card_share": f"""WITH {_CARDS}, s AS (
              SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes, entidad, sum(CAST(total AS DECIMAL(28,2))) AS t
              FROM tarjetas WHERE upper(clasificacion) = '1-URGENT' GROUP BY 1, 2)
            SELECT mes, entidad, CAST(t AS DOUBLE) AS total,
                   CAST(t AS DOUBLE) / nullif(CAST(sum(t) OVER (PARTITION BY mes) AS DOUBLE), 0) AS share FROM s""",
        "monthly_credit_by_product": f"""WITH {_CREDIT}, s AS (
              SELECT upper(actividad) AS producto, CAST(date_trunc('month', fecha) AS DATE) AS mes, entidad,
                     sum(CAST(cartera_total AS DECIMAL(28,2))) AS m, sum(CAST(cartera_vencida AS DECIMAL(28,2))) AS v
              FROM credito WHERE upper(actividad) IN ('ECONOMY', 'PROMO', 'LARGE') GROUP BY 1, 2, 3),
            d AS (SELECT producto, mes, entidad, CAST(m AS DOUBLE) AS monto, CAST(v AS DOUBLE) AS vencida,
                         CAST(sum(m) OVER (PARTITION BY producto, mes) AS DOUBLE) AS t FROM s)
            SELECT producto, mes, entidad, monto, vencida, monto / nullif(t, 0) AS share,
                   CASE WHEN monto > 0 THEN vencida / monto END AS morosidad FROM d""",
        "monthly_cards_by_class": f"""WITH {_CARDS}, s AS (
              SELECT clasificacion, CAST(date_trunc('month', fecha) AS DATE) AS mes, entidad,
                     sum(CAST(total AS DECIMAL(28,2))) AS t
              FROM tarjetas WHERE clasificacion IN ('1-URGENT', '5-LOW') GROUP BY 1, 2, 3)
            SELECT clasificacion, mes, entidad, CAST(t AS DOUBLE) AS total, CAST(t AS DOUBLE)
                   / nullif(CAST(sum(t) OVER (PARTITION BY clasificacion, mes) AS DOUBLE), 0) AS share FROM s""",
        "period_by_product": f"""WITH {_CREDIT}
            SELECT upper(actividad) AS producto, CAST(date_trunc('month', min(fecha)) AS DATE) AS desde,
                   CAST(date_trunc('month', max(fecha)) AS DATE) AS hasta,
                   strftime(min(fecha), '%b-%y') || ' a ' || strftime(max(fecha), '%b-%y') AS periodo
            FROM credito WHERE upper(actividad) IN ('ECONOMY', 'PROMO') GROUP BY 1""",
        "adjust_cutoff": f"""WITH {_FACTS}, r AS (SELECT min(fecha) AS lo, max(fecha) AS hi FROM hechos),
            p (pedido) AS (VALUES (DATE '1990-05-20'), (DATE '2000-02-29'), (DATE '2030-12-31'))
            SELECT pedido, lo AS min_mes, hi AS max_mes,
                   greatest(lo, least(hi, CAST(date_trunc('month', pedido) AS DATE))) AS corte FROM p, r""",
        "share_at_adjusted_cutoff": "WITH " + _share(
            "(SELECT CAST(max(fecha) - INTERVAL 23 MONTH AS DATE) FROM hechos)", "(SELECT max(fecha) FROM hechos)"
        ) + " SELECT * FROM cuota",
        "cutoff_composition": f"WITH {_MIX} SELECT * FROM mezcla",
        "composition_matrix": f"WITH {_MIX} SELECT banco, " + ", ".join(
            f"max(share_producto) FILTER (producto = '{p}') AS \"{p}\"" for p in _PRODUCTS
        ) + " FROM mezcla GROUP BY banco",
        "stack_base": f"""WITH {_MIX},
            g AS (SELECT banco, producto FROM (SELECT DISTINCT banco FROM mezcla), (SELECT DISTINCT producto FROM mezcla))
            SELECT banco, producto, share_producto, coalesce(sum(coalesce(share_producto, 0.0)) OVER (
                   PARTITION BY banco ORDER BY producto ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS base
            FROM g LEFT JOIN mezcla USING (banco, producto)""",
        "distinct_entities": f"WITH {_WINDOW} SELECT DISTINCT banco FROM cuota",
        "period_bounds": f"""WITH {_WINDOW} SELECT min(mes) AS desde, max(mes) AS hasta,
            strftime(min(mes), '%b-%y') || ' a ' || strftime(max(mes), '%b-%y') AS periodo FROM cuota""",
        "share_cap": f"WITH {_WINDOW} SELECT least(1.0::DOUBLE, max(share_mes) * 1.2::DOUBLE) AS tope FROM cuota",
        "share_labels": f"""WITH {_MIX} SELECT banco, producto,
            CAST(CAST(round_even(share_producto * 100, 0) AS BIGINT) AS VARCHAR) || '%' AS etiqueta FROM mezcla""",
        "wide_sheet_unpivot": f"""WITH {_FACTS} SELECT fecha,
              CASE WHEN banco IN ('NATION_1', 'NATION_2') THEN 'GRUPO NORTE' WHEN banco = 'NATION_12' THEN 'GRUPO SUR'
                   ELSE upper(banco[1]) || lower(banco[2:]) END AS banco,
              CASE producto WHEN 'ECONOMY' THEN 'Economia' WHEN 'PROMO' THEN 'Promocion' WHEN '1-URGENT' THEN 'TC'
                   ELSE 'Menudo' END AS producto, CAST(sum(monto) AS DOUBLE) AS monto
            FROM hechos WHERE producto IN ('ECONOMY', 'PROMO', 'SMALL', 'MEDIUM', '1-URGENT') GROUP BY 1, 2, 3""",
        "forward_fill": """SELECT o_orderstatus, o_orderkey, last_value(mes IGNORE NULLS) OVER (
              PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mes
            FROM (SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW')
                  THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS mes FROM orders)""",
        "parse_month": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
            THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS mes FROM orders""",
        "normalize_name": "SELECT doc_id, replace(regexp_replace(upper(" + _FOLDED.format("text")
                          + "), '^\\s+|\\s+$', '', 'g'), '  ', ' ') AS nombre FROM documents",
        "normalize_ligatures": "SELECT doc_id, replace(regexp_replace(upper(" + _FOLDED.format("text")
                               + "), '^\\s+|\\s+$', '', 'g'), '  ', ' ') AS nombre FROM documents",
        "normalize_text": "SELECT doc_id, trim(regexp_replace(lower(" + _FOLDED.format("text")
                          + "), '[^a-z0-9]+', ' ', 'g')) AS texto FROM documents",
        "bank_group": """SELECT c_custkey,
              CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN
                     CASE WHEN n_name IN ('NATION_1', 'NATION_2') THEN 'GRUPO NORTE'
                          WHEN n_name = 'NATION_12' THEN 'GRUPO SUR' ELSE upper(n_name[1]) || lower(n_name[2:]) END
                   ELSE 'Caja De ' || upper(n_name[1]) || lower(n_name[2:]) END AS banco,
              CASE WHEN c_mktsegment = 'BUILDING' THEN lower(n_name)
                   WHEN c_mktsegment = 'MACHINERY' THEN '  ' || n_name || chr(9)
                   WHEN c_mktsegment = 'AUTOMOBILE' THEN translate(n_name, 'AI', 'ÁÎ')
                   ELSE 'caja  de  ' || lower(n_name) END AS escrito
            FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "portfolio_consolidated": f"""WITH {_FACTS} SELECT fecha, banco, producto, CAST(sum(monto) AS DOUBLE) AS monto
            FROM hechos GROUP BY 1, 2, 3""",
        "portfolio_stored": f"""WITH {_FACTS} SELECT fecha, banco, producto, CAST(sum(monto) AS DOUBLE) AS monto
            FROM hechos GROUP BY 1, 2, 3""",
        "full_refresh": f"""WITH {_FACTS} SELECT fecha, banco, producto, CAST(sum(monto) AS DOUBLE) AS monto
            FROM hechos WHERE producto IN (SELECT p_type FROM part) GROUP BY 1, 2, 3""",
        "csv_roundtrip": f"WITH {_WINDOW} SELECT * FROM cuota",
        "link_methods": f"WITH {_LINKS} SELECT page_id, method, url, text, type FROM found",
        "link_extract": f"WITH {_LINKS} SELECT page_id, url, text, type, method FROM links",
        "link_dedupe": f"""WITH {_LINKS} SELECT page_id, url, text FROM found
            QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY r, pos) = 1""",
        "link_categorize": f"WITH {_LINKS} SELECT page_id, url, category FROM cats",
        "link_first": f"""WITH {_LINKS}, f AS (
              SELECT page_id, category, url FROM cats WHERE category <> 'otros'
              QUALIFY row_number() OVER (PARTITION BY page_id, category ORDER BY r, pos) = 1),
            n AS (SELECT page_id, count(category) AS n FROM pages LEFT JOIN f USING (page_id) GROUP BY page_id)
            SELECT page_id, category, url, CASE category WHEN 'tabla_a' THEN 'archivo_a' ELSE category END ||
                   coalesce(nullif(regexp_extract(url, '^https://[^/]*/?[^?]*[^/.?][^/?]*(\\.[^/.?]*)(\\?.*)?$', 1), ''),
                            '.xlsx') AS file_name, 'page' AS origin
            FROM f JOIN n USING (page_id) WHERE n = 2
            UNION ALL
            SELECT page_id, 'tabla_a', 'https://boletin.example/a.xls?v=1', 'archivo_a.xls', 'fallback' FROM n WHERE n < 2
            UNION ALL
            SELECT page_id, 'tabla_b', 'https://boletin.example/b/7f3c', 'tabla_b.xlsx', 'fallback' FROM n WHERE n < 2""",
        "sheet_select": f"WITH {_CHOSEN} SELECT file, target, sheet FROM chosen",
        "sheet_missing": f"""WITH {_CHOSEN}, asked AS (SELECT DISTINCT o_custkey AS file,
              unnest(['Urgente', 'Alto F', 'Bajo']) AS target FROM orders)
            SELECT file, target FROM asked ANTI JOIN chosen USING (file, target)""",
        "sheet_lines": f"""WITH {_CHOSEN}
            SELECT CASE WHEN file % 2 = 0 THEN '/m/tabla_de_bancos.' ELSE '/m/otra.' END || file || '.xlsx' AS file,
                   CASE target WHEN 'Urgente' THEN 'UR' WHEN 'Alto F' THEN 'HF' ELSE 'LO' END ||
                   CASE WHEN file % 2 = 0 THEN 'BI' ELSE 'XX' END AS salida, o_orderkey AS row_no,
                   o_orderkey || ',,"' || o_orderpriority || ', ' || repeat('"', 2) || 'x' || repeat('"', 3) || ',' ||
                   CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS value
            FROM chosen JOIN orders ON o_custkey = file AND o_orderpriority || ' - ' || o_orderstatus = sheet""",
        "file_manifest": """SELECT '2000-01-01T00:00:00' AS timestamp, 'page-' || page_id || '.html' AS filename,
              '/pages/page-' || page_id || '.html' AS path, octet_length(encode(html)) AS size,
              strftime(DATE '2000-01-01' + (page_id % 3650)::INTEGER, '%Y-%m-%d') AS modified FROM pages""",
        "written_files": """SELECT '2000-01-01T00:00:00' AS timestamp, 'grupo=' || (page_id // 64) AS carpeta,
              TRUE AS nombre_en_ruta, CAST(sum(octet_length(encode(coalesce(html, ''))) + 1) AS BIGINT) AS size,
              TRUE AS reciente FROM pages GROUP BY page_id // 64""",
        "file_validity": """SELECT page_id, octet_length(encode(html)) BETWEEN 1024 AND 104857600
              AND (url LIKE '%/en/%' OR url LIKE '%/fr/%') AS valido FROM pages""",
    }
