"""SQL twins of the registered queries, for an independent engine over the same tables.

Money is counted in whole cents or decimals and only turned into doubles at the end, so sums do
not depend on order. Months of coverage are rounded in whole numbers, half away from zero.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


NEWEST = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"
IN_ORDER = (
    "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax"
)
# Every character a Unicode-aware strip removes.
SPACES = " || ".join(f"chr({c})" for c in range(0x3001) if chr(c).isspace())
NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"

EXECUTION = """execution AS (
  SELECT l.*, o_orderpriority, o_custkey, o_orderstatus, s_name, p_name,
    l_orderkey AS id_llamado, o_orderpriority AS licitacion,
    CAST(l_partkey AS VARCHAR) AS codigo, CAST(l_linenumber AS VARCHAR) AS item,
    CAST(l_quantity AS BIGINT) AS maxima,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS emitida,
    CASE WHEN l_linestatus = 'F' THEN 100.0 ELSE 0.0 END AS pct,
    CASE WHEN l_returnflag <> 'N'
      THEN CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) END AS cents
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

DIRTY = """dirty AS (
  SELECT * REPLACE (CASE WHEN l_discount = 0.1 AND l_linestatus = 'F' THEN '  '
      WHEN l_discount = 0.1 THEN NULL
      WHEN l_linestatus = 'O' THEN ' ' || codigo || ' ' ELSE codigo END AS codigo)
  FROM execution)"""

ITEMS = f"""items AS (
  SELECT * FROM execution
  QUALIFY row_number() OVER (PARTITION BY id_llamado, licitacion, item ORDER BY {NEWEST}) = 1)"""

STOCK = """stock AS (
  SELECT CAST(p_partkey AS VARCHAR) AS codigo, p_name AS producto,
    CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE (p_partkey % 10) * 10 END AS disponible,
    (p_size - 1) * 2 AS dmp,
    CASE WHEN p_size < 10 THEN 'critico' WHEN p_size < 25 THEN 'bajo'
      WHEN p_size < 45 THEN 'normal' END AS estado
  FROM part)"""

LOTS = """lots AS (
  SELECT CAST(l_partkey AS VARCHAR) AS codigo,
    sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS vigentes
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_shipdate >= DATE '2001-06-01' GROUP BY 1)"""

CLOSED = """['entregado', 'finalizado', 'completado', 'completada', 'entrega parcial',
  'entrega total']"""
ORDERS = f"""ordenes AS (
  SELECT l.*, o_orderstatus, l_orderkey AS id_llamado,
    CASE WHEN l_linestatus = 'O' THEN ' ' || o_orderpriority || '  ' ELSE o_orderpriority END
      AS llamado,
    CASE l_linenumber WHEN 3 THEN '  ' || s_name || ' ' WHEN 5 THEN NULL ELSE s_name END
      AS proveedor, CAST(l_partkey AS VARCHAR) AS codigo,
    CAST(l_linenumber AS VARCHAR) AS item, 'OC-' || CAST(l_suppkey AS VARCHAR) AS oc,
    CASE WHEN o_orderstatus = 'F' THEN ' ' || upper({CLOSED}[(l_linenumber - 1) % 6 + 1]) || ' '
      WHEN o_orderstatus = 'O' AND l_linenumber = 2 THEN 'Finalizado'
      WHEN o_orderstatus = 'P' THEN 'Pendiente' END AS estado,
    CAST(l_extendedprice AS DECIMAL(18, 2)) AS saldo,
    CAST(l_shipdate AS DATE) AS fecha_orden
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey)"""

PENDING = f"""pending AS (
  SELECT id_llamado, trim(llamado) AS licitacion, coalesce(trim(proveedor), '') AS proveedor,
    codigo, sum(saldo) AS pendiente
  FROM ordenes WHERE estado IS NULL OR NOT list_contains({CLOSED}, lower(trim(estado)))
  GROUP BY ALL)"""

CONTRACTS = """contracts AS (
  SELECT o_orderkey AS id_llamado, o_orderpriority AS licitacion,
    CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE ' ' || c_name END AS descripcion_llamado,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS dirigido_a,
    'Parque ' || CAST(c_nationkey AS VARCHAR) AS lugares,
    CASE o_orderstatus WHEN 'F' THEN 'NO' WHEN 'P' THEN 'SI' END AS vigente,
    CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

REQUESTED = f"""requested AS (
  SELECT l_orderkey AS id_llamado, o_orderpriority AS licitacion,
    CAST(l_partkey AS VARCHAR) AS codigo, CAST(l_linenumber AS VARCHAR) AS item,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS solicitada,
    CAST(l_shipdate AS DATE) AS emitir_en,
    CASE WHEN l_linestatus = 'F' THEN 'OC ' || o_orderstatus END AS comentario
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, o_orderpriority, l_partkey, l_linenumber
    ORDER BY {NEWEST}) = 1)"""

# Rounding n / d to one decimal in whole numbers.
ROUNDED = "sign({n}) * ((abs({n}) * 20 + {d}) // (2 * {d})) / 10.0"


def _board(source: str = "items", requests: bool = True, legacy: bool = False) -> str:
    pedida = "coalesce(r.solicitada, 0)" if requests else "0"
    total = "coalesce(stock_actual, 0) + maxima - emitida + pedida"
    coverage = (
        "CAST(maxima - emitida + pedida AS DOUBLE) / CAST(dmp_actual AS DOUBLE)"
        if legacy
        else ROUNDED.format(n=f"({total})", d="dmp_actual")
    )
    level = (
        """CASE WHEN dmp_actual = 0 THEN 'Sin DMP' WHEN stock_actual = 0 THEN 'Sin Stock'
      WHEN stock_actual * 10 < dmp_actual * 3 THEN 'Crítico'
      WHEN stock_actual * 10 < dmp_actual * 7 THEN 'Atención' ELSE 'Óptimo' END"""
        if legacy
        else """CASE WHEN dmp_actual = 0 THEN 'Sin DMP' WHEN stock_actual = 0 THEN 'Sin Stock'
      WHEN meses < 1 THEN 'Crítico' WHEN meses <= 3 THEN 'Atención' ELSE 'Óptimo' END"""
    )
    return f"""joined AS (
  SELECT e.id_llamado, e.licitacion, e.codigo, e.item, e.p_name AS producto,
    e.s_name AS proveedor, e.maxima, e.emitida, e.pct,
    coalesce(nullif(trim(d.descripcion_llamado), ''), e.licitacion) AS nombre_llamado,
    coalesce(e.cents, d.total_cents) AS precio_cents, coalesce(d.dirigido_a, '') AS dirigido_a,
    coalesce(d.lugares, '') AS lugar, coalesce(d.vigente, '') AS vigente,
    coalesce(p.pendiente, 0) AS pendiente,
    CAST(coalesce(nullif(v.vigentes, 0), s.disponible, 0) AS BIGINT) AS stock_actual,
    CAST(coalesce(s.dmp, 0) AS BIGINT) AS dmp_actual, CAST({pedida} AS BIGINT) AS pedida,
    r.emitir_en, r.comentario
  FROM {source} e LEFT JOIN contracts d ON e.id_llamado = d.id_llamado
  LEFT JOIN pending p ON e.id_llamado = p.id_llamado AND e.licitacion = p.licitacion
    AND e.s_name = p.proveedor AND e.codigo = p.codigo
  LEFT JOIN stock s ON e.codigo = s.codigo LEFT JOIN lots v ON e.codigo = v.codigo
  LEFT JOIN requested r ON e.id_llamado = r.id_llamado AND e.licitacion = r.licitacion
    AND e.codigo = r.codigo AND e.item = r.item),
months AS (SELECT *, CASE WHEN dmp_actual > 0 THEN {coverage} END AS meses FROM joined),
levels AS (SELECT *, {level} AS nivel_stock FROM months),
board AS (
  SELECT id_llamado, licitacion, nombre_llamado, codigo, producto, proveedor,
    CAST(maxima AS DOUBLE) AS cantidad_maxima, CAST(emitida AS DOUBLE) AS cantidad_emitida,
    CAST(maxima - emitida AS DOUBLE) AS saldo_contrato,
    CAST(pct AS DOUBLE) AS porcentaje_emitido,
    CAST(precio_cents AS DOUBLE) / 100.0 AS precio_unitario, precio_cents, item, dirigido_a,
    lugar, vigente,
    CAST(pendiente AS DOUBLE) AS pendiente_entrega, CAST(stock_actual AS DOUBLE) AS stock_actual,
    CAST(dmp_actual AS DOUBLE) AS dmp_actual, CAST(pedida AS DOUBLE) AS cantidad_solicitada,
    strftime(emitir_en, '%Y-%m-%d') AS ver_en_fecha, comentario,
    CAST(meses AS DOUBLE) AS cobertura_meses, nivel_stock
  FROM levels)"""


SIDES = (STOCK, LOTS, ORDERS, PENDING, CONTRACTS, REQUESTED)
BOARD = _with(EXECUTION, ITEMS, *SIDES, _board())
CORE = """id_llamado, licitacion, codigo, item, cantidad_maxima, cantidad_emitida, saldo_contrato,
  stock_actual, dmp_actual, cobertura_meses, nivel_stock"""

ORACLE["board_core"] = (
    _with(EXECUTION, ITEMS, *SIDES, _board(requests=False)) + f"SELECT {CORE} FROM board"
)
ORACLE["board_full"] = BOARD + "SELECT * EXCLUDE (precio_cents) FROM board"
ORACLE["board_legacy"] = (
    _with(EXECUTION, *SIDES, _board("execution", legacy=True))
    + "SELECT * EXCLUDE (precio_cents) FROM board"
)
ORACLE["board_null_safe"] = _with(
    EXECUTION,
    REQUESTED,
    f"""partly AS (
  SELECT * REPLACE (CASE WHEN maxima > 25 THEN item END AS item) FROM execution
  QUALIFY row_number() OVER (PARTITION BY id_llamado, licitacion, codigo,
    CASE WHEN maxima > 25 THEN item END ORDER BY {NEWEST}) = 1)""",
    """saved AS (
  SELECT id_llamado, licitacion, codigo, sum(solicitada) AS solicitada, max(emitir_en) AS dia
  FROM requested GROUP BY ALL)""",
) + """SELECT e.id_llamado, e.codigo, e.item, CAST(coalesce(s.solicitada, 0) AS DOUBLE)
    AS cantidad_solicitada, strftime(s.dia, '%Y-%m-%d') AS ver_en_fecha
  FROM partly e LEFT JOIN saved s ON e.id_llamado = s.id_llamado AND e.licitacion = s.licitacion
    AND e.codigo = s.codigo AND e.item IS NULL"""
ORACLE["coverage_grid"] = BOARD + """SELECT id_llamado, item, stock_actual, cantidad_solicitada,
    dmp_actual, CASE WHEN dmp_actual <> 0 THEN (stock_actual + cantidad_solicitada) / dmp_actual
      END AS cobertura_grilla,
    coalesce(dmp_actual <> 0 AND stock_actual + cantidad_solicitada < dmp_actual, false)
      AS fila_roja
  FROM board"""
ORACLE["unexpired_stock_by_code"] = (
    _with(LOTS) + "SELECT codigo, CAST(vigentes AS DOUBLE) AS stock_sin_vencidos FROM lots"
)
ORACLE["pending_delivery_by_item"] = _with(ORDERS, PENDING) + """SELECT id_llamado, licitacion,
    proveedor, codigo, CAST(pendiente AS DOUBLE) AS pendiente_entrega FROM pending"""
ORACLE["board_page"] = BOARD + """SELECT id_llamado, licitacion, codigo, item, nivel_stock,
    cobertura_meses FROM board ORDER BY id_llamado, item LIMIT 200 OFFSET 400"""
ORACLE["board_page_deep"] = BOARD + """SELECT id_llamado, licitacion, codigo, item, nivel_stock
  FROM board ORDER BY id_llamado, item LIMIT 200
  OFFSET (SELECT (count(*) // 200 - 1) * 200 FROM board)"""
ORACLE["board_page_after"] = BOARD + """SELECT id_llamado, licitacion, codigo, item, nivel_stock
  FROM board WHERE id_llamado > 100 OR (id_llamado = 100 AND item > '3')
  ORDER BY id_llamado, item LIMIT 500"""
ORACLE["board_preview"] = BOARD + """SELECT licitacion, codigo, producto, cantidad_maxima,
    cantidad_emitida, saldo_contrato, stock_actual, dmp_actual, nivel_stock, cantidad_solicitada,
    cobertura_meses
  FROM board ORDER BY id_llamado, item LIMIT 1000"""
ORACLE["board_titles"] = BOARD + """SELECT id_llamado AS "ID Llamado", licitacion AS "Licitación",
    codigo AS "Código", item AS "Ítem", cantidad_maxima AS "Cantidad máxima",
    cantidad_emitida AS "Cantidad emitida", saldo_contrato AS "Saldo contrato",
    stock_actual AS "Stock actual", dmp_actual AS "DMP", cobertura_meses AS "Cobertura (meses)",
    nivel_stock AS "Nivel stock" FROM board"""

# --- dedupe ---------------------------------------------------------------------------------

LINE = """id_llamado, licitacion, codigo, item, CAST(maxima AS DOUBLE) AS cantidad_maxima,
    CAST(emitida AS DOUBLE) AS cantidad_emitida, CAST(pct AS DOUBLE) AS porcentaje_emitido,
    CAST(cents AS DOUBLE) / 100.0 AS precio_unitario,
    CASE WHEN l_linestatus = 'F' THEN l_quantity END AS cantidad_ejecutada,
    l_extendedprice AS monto_total, strftime(l_shipdate, '%Y-%m-%d') AS fecha_ejecucion"""
ORACLE["dedupe_latest"] = _with(EXECUTION, DIRTY) + f"""SELECT {LINE} FROM dirty
  WHERE trim(codigo) <> ''
  QUALIFY row_number() OVER (PARTITION BY id_llamado, licitacion, item ORDER BY {NEWEST}) = 1"""
ORACLE["dedupe_keep_blank"] = (
    ORACLE["dedupe_latest"]
    + f"\nUNION ALL SELECT {LINE} FROM dirty WHERE codigo IS NULL OR trim(codigo) = ''"
)
ORDER_ROW = """id_llamado, llamado, proveedor, codigo, item, oc, estado,
    CAST(saldo AS DOUBLE) AS saldo, strftime(fecha_orden, '%Y-%m-%d') AS fecha_orden"""
ORACLE["dedupe_orders"] = _with(ORDERS) + f"""SELECT {ORDER_ROW} FROM ordenes
  QUALIFY row_number() OVER (PARTITION BY llamado, codigo, item, oc ORDER BY {NEWEST}) = 1"""
ORACLE["dedupe_orders_five_keys"] = _with(ORDERS, """twice AS (
  SELECT *, 1 AS vez FROM ordenes
  UNION ALL SELECT * REPLACE (saldo + 1 AS saldo, ' ' || codigo AS codigo, item || '  ' AS item), 0
  FROM ordenes WHERE l_linestatus = 'O')""") + f"""SELECT {ORDER_ROW} FROM twice
  QUALIFY row_number() OVER (PARTITION BY id_llamado, llamado, trim(codigo), trim(item), oc
    ORDER BY vez DESC, {NEWEST}) = 1"""
ORACLE["append_newest_wins"] = f"""SELECT l_orderkey AS id_llamado, o_orderpriority AS licitacion,
    CAST(l_partkey AS VARCHAR) AS codigo, CAST(l_linenumber AS VARCHAR) AS item,
    CAST(l_quantity AS DOUBLE) AS cantidad_maxima, CAST(l_extendedprice AS DOUBLE) AS monto_total,
    strftime(l_shipdate, '%Y-%m-%d') AS fecha_ejecucion
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, o_orderpriority, l_linenumber
    ORDER BY strpos('ANR', l_returnflag) DESC, {NEWEST}) = 1"""
ORACLE["dedupe_by_date"] = f"""SELECT l_suppkey AS oc, l_linenumber AS item, l_quantity AS codigo,
    CASE WHEN l_returnflag <> 'N' THEN strftime(l_shipdate, '%Y-%m-%d') END AS fecha_oc,
    l_extendedprice AS monto_oc
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_quantity
    ORDER BY CASE WHEN l_returnflag <> 'N' THEN l_shipdate END DESC NULLS LAST, {IN_ORDER}) = 1"""
ORACLE["dedupe_first"] = f"""SELECT l_orderkey AS id_llamado, l_linenumber AS item,
    l_partkey AS codigo, l_suppkey AS proveedor, l_quantity AS cantidad
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {IN_ORDER}) = 1"""
ORACLE["dedupe_complete"] = """WITH raw AS (
  SELECT l_orderkey AS id_llamado, l_linenumber AS item, l_partkey AS codigo,
    CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS proveedor,
    CASE WHEN l_linestatus = 'F' THEN l_quantity END AS cantidad,
    CASE WHEN l_tax > 0 THEN l_extendedprice END AS monto FROM lineitem)
SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY id_llamado, item
  ORDER BY (proveedor IS NOT NULL)::INT + (cantidad IS NOT NULL)::INT + (monto IS NOT NULL)::INT
    DESC, codigo, proveedor NULLS LAST, cantidad NULLS LAST, monto NULLS LAST) = 1"""
ORACLE["dup_audit"] = _with(EXECUTION, DIRTY, ORDERS) + """
SELECT 'ejecucion' AS tabla, count(*) AS total_registros, count(DISTINCT (id_llamado, licitacion,
    coalesce(CASE WHEN maxima > 5 THEN item END, '-'))) AS registros_unicos
  FROM dirty WHERE trim(codigo) <> ''
UNION ALL SELECT 'ordenes', count(*), count(DISTINCT (llamado, codigo, item, oc)) FROM ordenes"""

# --- figures and lists ----------------------------------------------------------------------

KPIS = """SELECT count(*) AS total_items,
    count(*) FILTER (nivel_stock IN ('Crítico', 'Sin Stock')) AS items_criticos,
    count(*) FILTER (nivel_stock IN ('Crítico', 'Sin Stock')) * 100.0 / count(*)
      AS porcentaje_criticos,
    sum(cantidad_maxima) * ((CAST(sum(coalesce(precio_cents, 0)) AS DOUBLE) / 100.0)
      / count(*)) AS monto_estimado,
    sum(cantidad_solicitada) AS cantidad_solicitada FROM board"""
ORACLE["board_kpis"] = BOARD + KPIS
ORACLE["board_kpis_by_choice"] = (
    BOARD + KPIS + " WHERE licitacion = '2-HIGH' AND nivel_stock = 'Crítico'"
)
ORACLE["critical_items"] = BOARD + """SELECT licitacion, codigo, producto, nivel_stock,
    stock_actual, cantidad_solicitada FROM board WHERE nivel_stock IN ('Crítico', 'Sin Stock')"""
ORACLE["low_coverage"] = BOARD + """SELECT licitacion, codigo, producto, cobertura_meses,
    nivel_stock, cantidad_solicitada FROM board WHERE cobertura_meses < 1"""
ORACLE["consumption_top10"] = BOARD + """SELECT licitacion, sum(cantidad_maxima) AS cantidad_maxima,
    sum(cantidad_emitida) AS cantidad_emitida FROM board GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
ORACLE["level_distribution"] = (
    BOARD + "SELECT nivel_stock, count(*) AS cantidad FROM board GROUP BY 1"
)
ORACLE["stock_distribution"] = _with(STOCK) + """SELECT estado, count(*) AS cantidad FROM stock
  WHERE estado IS NOT NULL GROUP BY 1"""
ORACLE["orders_kpis"] = _with(ORDERS) + """SELECT count(*) AS total_ordenes,
    CAST(sum(saldo) AS DOUBLE) AS saldo_total, count(*) FILTER (estado = 'Pendiente') AS pendientes
  FROM ordenes"""
ORACLE["orders_pending"] = (
    _with(ORDERS) + f"SELECT {ORDER_ROW} FROM ordenes WHERE estado = 'Pendiente'"
)
ORACLE["orders_sorted"] = (
    _with(ORDERS) + f"SELECT {ORDER_ROW} FROM ordenes ORDER BY fecha_orden DESC"
)
REQUESTS = """pedidos AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS nro_pedido, 'C' || CAST(o_custkey AS VARCHAR) AS codigo,
    c_name AS medicamento, o_orderstatus AS estado, o_orderpriority AS prioridad,
    CAST(o_totalprice AS DECIMAL(18, 2)) AS solicitada,
    CASE o_orderstatus WHEN 'P' THEN CAST(o_totalprice AS DECIMAL(18, 2)) WHEN 'O' THEN 0
      END AS pendiente, strftime(o_orderdate, '%Y-%m-%d') AS fecha_solicitud
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
ORACLE["requests_kpis"] = _with(REQUESTS) + """SELECT count(*) AS total_pedidos,
    CAST(sum(solicitada) AS DOUBLE) AS solicitada_total,
    CAST(sum(pendiente) AS DOUBLE) AS pendiente_total FROM pedidos"""
ORACLE["requests_pending"] = _with(REQUESTS) + """SELECT nro_pedido, codigo, medicamento, estado,
    prioridad, CAST(solicitada AS DOUBLE) AS cantidad_solicitada,
    CAST(pendiente AS DOUBLE) AS cantidad_pendiente, fecha_solicitud
  FROM pedidos WHERE pendiente > 0"""
ORACLE["execution_kpis"] = """SELECT count(*) AS total_items,
    sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS cantidad_total,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS monto_total FROM lineitem"""
ORACLE["execution_top100"] = _with(EXECUTION) + """SELECT id_llamado, licitacion, codigo, item,
    s_name AS proveedor, l_extendedprice AS monto_total FROM execution
  ORDER BY l_extendedprice DESC, id_llamado, item, codigo, l_shipdate LIMIT 100"""
ORACLE["stock_kpis"] = _with(STOCK) + """SELECT count(*) AS total_productos,
    count(*) FILTER (estado = 'critico') AS criticos,
    CAST(sum(disponible) AS DOUBLE) AS stock_total FROM stock"""
ORACLE["stock_critical"] = _with(STOCK) + """SELECT codigo, producto,
    CAST(disponible AS DOUBLE) AS stock_disponible, CAST(0 AS DOUBLE) AS stock_actual,
    CAST(dmp AS DOUBLE) AS dmp, estado FROM stock WHERE estado = 'critico'"""
ORACLE["filter_options"] = _with(STOCK, ORDERS) + """
SELECT 'producto' AS lista, producto AS valor FROM (SELECT DISTINCT producto FROM stock)
UNION ALL SELECT 'licitacion', o FROM (SELECT DISTINCT o_orderpriority AS o
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
UNION ALL SELECT 'proveedor', proveedor
  FROM (SELECT DISTINCT proveedor FROM ordenes WHERE proveedor IS NOT NULL)
UNION ALL SELECT 'estado', estado FROM (SELECT DISTINCT estado FROM ordenes)"""
ORACLE["tender_pairs"] = """SELECT DISTINCT l_orderkey AS id_llamado, o_orderpriority AS licitacion,
    CAST(l_orderkey AS VARCHAR) || ' - ' || o_orderpriority AS display
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
ORACLE["tender_keys_parsed"] = """SELECT o_orderkey AS id_llamado,
    o_orderpriority || ' - ' || o_orderstatus AS licitacion,
    CAST(o_orderkey AS VARCHAR) || ' - ' || o_orderpriority || ' - ' || o_orderstatus AS display
  FROM orders"""
ORACLE["grid_contains"] = BOARD + """SELECT id_llamado, item, producto, cantidad_maxima, nivel_stock
  FROM board WHERE lower(producto) LIKE '%widget%' AND CAST(id_llamado AS VARCHAR) LIKE '%12%'
    AND CAST(CAST(cantidad_maxima AS BIGINT) AS VARCHAR) LIKE '%1%'"""
ORACLE["grid_date"] = BOARD + """SELECT id_llamado, item, ver_en_fecha, cantidad_solicitada
  FROM board WHERE ver_en_fecha = '1998-06-15'"""
ORACLE["contract_lookup"] = _with(CONTRACTS) + """SELECT * EXCLUDE (total_cents),
    CAST(total_cents AS DOUBLE) / 100.0 AS precio_unitario FROM contracts WHERE id_llamado = 77"""

# --- cleaning -------------------------------------------------------------------------------


def _variants(*texts: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(texts[:-1], start=1))
    return f"CASE l_linenumber {cases} ELSE {texts[-1]} END"


_DIRTY_TEXT = _variants(
    "'nan'", "' NaT '", "chr(9) || 'None' || chr(160)", "'NAN'", "'  '",
    "CASE l_returnflag WHEN 'A' THEN '#N/A' WHEN 'R' THEN 'NULL' END",
    "' ' || l_returnflag || chr(9) || l_linestatus || chr(160)",
)
ORACLE["clean_text_policies"] = f"""WITH raw AS (
  SELECT l_orderkey, l_linenumber, {_DIRTY_TEXT} AS t FROM lineitem),
cut AS (SELECT *, trim(t, {SPACES}) AS s FROM raw)
SELECT l_orderkey, l_linenumber,
  CASE WHEN s NOT IN ('nan', 'NaT', 'None', 'NaN', '') THEN s END AS nulo,
  CASE WHEN s NOT IN ('nan', 'NaT', 'None', 'NaN') THEN s ELSE '' END AS vacio,
  CASE WHEN lower(s) NOT IN ('nan', 'nat', 'none', '', 'null', 'n/a') THEN s END AS palabras,
  CASE WHEN t NOT IN ('', ' ', 'NULL', 'null', 'None', '#N/A', '#REF!') THEN t END AS celda,
  CASE WHEN t NOT IN ('nan', '#N/A', 'NULL') THEN t END AS lector
FROM cut"""
_AMOUNT = "CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR)"
ORACLE["coerce_numbers"] = f"""WITH raw AS (SELECT l_orderkey, l_linenumber, {_variants(
    f"' ' || {_AMOUNT} || chr(9)",
    f"'-' || {_AMOUNT}",
    f"'Gs. ' || replace({_AMOUNT}, '.', ',')",
    "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'e2'",
    "'2-2.2'",
    "CASE l_returnflag WHEN 'A' THEN '1d' WHEN 'R' THEN 'nan' END",
    "'1.234,50'",
)} AS t FROM lineitem),
cut AS (SELECT *, trim(t, {SPACES}) AS s,
  replace(regexp_replace(t, '[^0-9.,-]', '', 'g'), ',', '.') AS k FROM raw)
SELECT l_orderkey, l_linenumber,
  CASE WHEN regexp_full_match(s, '{NUMBER}') THEN CAST(s AS DOUBLE) ELSE 0 END AS cero,
  CASE WHEN regexp_full_match(s, '{NUMBER}') THEN CAST(s AS DOUBLE) END AS nulo,
  CASE WHEN regexp_full_match(k, '{NUMBER}') THEN CAST(k AS DOUBLE) ELSE -1 END AS indulgente
FROM cut"""
# What each text stands for is known from how it was written.
_DAY = _variants(
    *["CAST(l_shipdate AS DATE)"] * 5, "CASE WHEN l_returnflag = 'R' THEN DATE '5000-12-31' END",
    "NULL",
)
_DAY_VALUE = _variants(
    *["CAST(l_shipdate AS DATE)"] * 4, "NULL",
    "CASE WHEN l_returnflag = 'R' THEN DATE '5000-12-31' END", "NULL",
)
_PHRASE = """l_linenumber = 6 AND l_returnflag = 'N' AND l_linestatus = 'F'"""
ORACLE["coerce_dates"] = f"""WITH d AS (SELECT l_orderkey, l_linenumber, {_DAY} AS f, {_DAY_VALUE} AS v,
    CASE WHEN {_PHRASE} THEN 'Cumplimiento total de las obligaciones' END AS frase FROM lineitem)
SELECT l_orderkey, l_linenumber, strftime(f, '%Y-%m-%d') AS fecha,
  strftime(f, '%d/%m/%Y') AS texto, coalesce(strftime(f, '%d/%m/%Y'), '-') AS informe,
  strftime(v, '%Y-%m-%d') AS valor, frase FROM d"""
ORACLE["coerce_dates_strict"] = """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber <= 2 THEN strftime(l_shipdate, '%Y-%m-%d')
      WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN '5000-12-31' END AS mezclada,
    CASE WHEN l_linenumber % 3 = 1 THEN strftime(l_shipdate, '%Y-%m-%d') END AS iso_primero,
    strftime(l_shipdate, '%Y-%m-%d') AS guiones, CAST(NULL AS VARCHAR) AS nada
  FROM lineitem"""


def _formatted(x: str, comma: str = ".") -> str:
    whole = f"replace(format('{{:,.0f}}', {x}), ',', '.')"
    part = f"translate(regexp_replace(format('{{:,.2f}}', {x}), '\\.?0+$', ''), ',.', '.{comma}')"
    return f"CASE WHEN {x} IS NULL THEN '-' WHEN {x} = floor({x}) THEN {whole} ELSE {part} END"


ORACLE["format_numbers"] = f"""WITH v AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS p,
    l_quantity * 1000 AS q, -(l_extendedprice / 7) AS r, l_discount * 100 AS d,
    CASE WHEN l_returnflag <> 'N' THEN l_tax / 3 END AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, {_formatted('p')} AS monto, '$' || {_formatted('q')} AS entero,
  {_formatted('r', ',')} AS coma,
  CASE WHEN d = floor(d) THEN format('{{:.0f}}%', d) ELSE format('{{:.1f}}%', d) END AS porcentaje,
  CASE WHEN c IS NULL THEN '-' ELSE '$' || ({_formatted('c')}) END AS chico
FROM v"""
ORACLE["sanitize_text"] = f"""SELECT doc_id,
    trim(replace(text, '''', ''''''), {SPACES}) AS texto FROM documents"""
ORACLE["clean_names"] = f"""WITH names AS (
  SELECT text AS t FROM conversations
  UNION ALL SELECT ' 1º ' || p_name || ' (Código) ' FROM part
  UNION ALL SELECT CASE WHEN n_nationkey > 9 THEN '¡Table!' END FROM nation),
folded AS (SELECT regexp_replace(lower(strip_accents(replace(trim(t, {SPACES}), 'º', 'o'))),
    '[^\\x00-\\x7F]', '', 'g') AS t FROM names),
cut AS (SELECT regexp_replace(regexp_replace(regexp_replace(t, '[^a-z0-9_\\s]', '', 'g'),
    '\\s+', '_', 'g'), '^[0-9]+', '') AS t FROM folded)
SELECT CASE WHEN t IS NULL OR t = '' THEN 'unnamed' WHEN t = 'table' THEN 'col_table' ELSE t END
  AS limpio FROM cut"""
_KEY = "CAST(l_orderkey AS VARCHAR)"
_RAW_ID = _variants(
    _KEY, f"{_KEY} || '.9'", f"' ' || {_KEY} || ' '", f"'-' || {_KEY} || '.0'", f"{_KEY} || '-2'",
    "NULL", f"{_KEY} || 'e1'",
)
_ID = _variants(
    "l_orderkey", "l_orderkey", "l_orderkey", "-l_orderkey", "NULL", "NULL", "l_orderkey * 10"
)
ORACLE["normalize_ids"] = f"SELECT l_linenumber, {_RAW_ID} AS crudo, {_ID} AS id FROM lineitem"
ORACLE["vigente_flags"] = """SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'O' THEN 'SI' ELSE 'NO' END AS vigente FROM orders"""
ORACLE["date_alerts"] = """WITH d AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N'
    THEN CAST(l_shipdate AS DATE) - DATE '1998-06-15' END AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN n IS NULL THEN 'sin fecha' WHEN n < 0 THEN 'vencida'
    WHEN n <= 15 THEN 'próxima' ELSE 'en plazo' END AS alerta FROM d"""
ORACLE["traffic_light"] = """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'O' THEN 'rojo' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'rojo'
    WHEN '2-HIGH' THEN 'rojo' WHEN '3-MEDIUM' THEN 'amarillo' WHEN '5-LOW' THEN 'verde' END
    END AS nivel,
  CASE WHEN o_orderstatus <> 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'rojo'
    WHEN '2-HIGH' THEN 'rojo' WHEN '3-MEDIUM' THEN 'amarillo' WHEN '5-LOW' THEN 'verde' END
    END AS parque
FROM orders"""
ORACLE["level_lights"] = BOARD + """SELECT id_llamado, item, nivel_stock, CASE
    WHEN nivel_stock IN ('Crítico', 'Sin Stock') THEN 'rojo' WHEN nivel_stock = 'Óptimo'
    THEN 'verde' ELSE 'amarillo' END AS color FROM board"""

# --- extracts -------------------------------------------------------------------------------

ORACLE["load_orders"] = f"""WITH raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id_llamado, o_orderpriority AS llamado,
    CASE WHEN l_returnflag = 'N' THEN '' ELSE 'OC-' || CAST(l_suppkey AS VARCHAR) END AS oc,
    CAST(l_linenumber AS VARCHAR) || '-2.2' AS item,
    'Q' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS codigo,
    CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END AS p_unit,
    l_quantity AS cant_oc,
    CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS BIGINT) ELSE 0 END AS dias_de_atraso,
    CASE WHEN l_returnflag <> 'N' OR l_tax <> 0 THEN l_shipdate END AS d,
    l_extendedprice AS saldo, l.*
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)
SELECT id_llamado, llamado, oc, item, codigo, p_unit, cant_oc, dias_de_atraso,
  strftime(d, '%d/%m/%Y') AS fecha_oc, saldo
FROM raw QUALIFY row_number() OVER (PARTITION BY oc, item, codigo
  ORDER BY d DESC NULLS LAST, {IN_ORDER}) = 1"""
ORACLE["load_execution"] = f"""WITH raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id_llamado, o_orderpriority AS licitacion,
    CASE WHEN l_returnflag <> 'N' THEN 'P' || CAST(o_custkey AS VARCHAR) END AS codigo,
    CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS VARCHAR) END AS item,
    l_quantity AS cantidad_maxima,
    CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS cantidad_emitida,
    l_extendedprice AS monto_adjudicado, CAST(NULL AS VARCHAR) AS obs, l.*
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)
SELECT id_llamado, licitacion, codigo, item, cantidad_maxima, cantidad_emitida, monto_adjudicado,
  obs
FROM raw QUALIFY row_number() OVER (PARTITION BY id_llamado, licitacion, codigo, item
  ORDER BY {IN_ORDER}) = 1"""
ORACLE["load_stock"] = f"""SELECT CAST(p_partkey AS VARCHAR) AS codigo, p_name AS producto,
    CASE WHEN p_size >= 10 THEN p_brand END AS presentacion, l_extendedprice AS stock_disponible,
    CASE WHEN l_returnflag <> 'A' THEN CAST(p_size AS DOUBLE) END AS dmp,
    l_linenumber AS meses_en_movimiento, CAST(NULL AS DOUBLE) AS stock_hosp,
    CAST(NULL AS VARCHAR) AS oc
  FROM lineitem JOIN part ON l_partkey = p_partkey
  QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY {IN_ORDER}) = 1"""
ORACLE["load_requests"] = f"""SELECT CAST(o_orderkey AS VARCHAR) AS nro_pedido,
    'C' || CAST(l_linenumber AS VARCHAR) AS codigo, o_orderpriority AS prioridad,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS estado,
    CASE WHEN l_tax > 0.02 THEN l_quantity END AS cantidad,
    strftime(o_orderdate, '%Y-%m-%d') AS fecha_pedido
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY o_orderkey, l_linestatus = 'F', l_linenumber
    ORDER BY {IN_ORDER}) = 1"""
_EXPIRY = """long AS (
  SELECT CAST(l_partkey AS VARCHAR) || ' ' AS codigo,
    'PNC ' || CAST(s_nationkey AS VARCHAR) AS parque,
    CASE WHEN l_tax > 0 THEN date_trunc('year', l_shipdate)::DATE ELSE DATE '5000-12-31' END AS d,
    CASE WHEN l_linestatus = 'F' THEN ' Stock Disponible'
      WHEN l_returnflag = 'N' THEN 'stock disponible' || chr(9) ELSE 'Stock Reservado' END AS m,
    CASE WHEN l_discount > 0.01 THEN l_quantity END AS n, l.*
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey)"""
_LOTS_ONLY = "WHERE l_linestatus = 'F' OR l_returnflag = 'N'"
ORACLE["load_expiry"] = _with(_EXPIRY) + f"""SELECT trim(codigo) AS codigo, parque,
    strftime(d, '%Y-%m-%d') AS fec_vencimiento, coalesce(n, 0) AS stock_disponible
  FROM long {_LOTS_ONLY}
  QUALIFY row_number() OVER (PARTITION BY codigo, parque, d ORDER BY {IN_ORDER}) = 1"""
ORACLE["measure_filter"] = _with(_EXPIRY) + f"""SELECT codigo AS codigo_producto,
    parque AS nombre_sucursal, strftime(d, '%d/%m/%Y') AS fecha_vencimiento,
    m AS "Nombres de medidas",
    coalesce(CAST(CAST(n AS DECIMAL(18, 2)) AS VARCHAR), 'sin dato') AS stock_disponible
  FROM long {_LOTS_ONLY}"""
ORACLE["repair_sheet"] = """SELECT CAST(l_orderkey AS VARCHAR) AS "Id Llamado",
    CASE WHEN l_returnflag <> 'A' THEN l_linestatus END AS "Estado",
    CASE WHEN l_tax <> 0 THEN l_returnflag END AS "Obs" FROM lineitem WHERE l_linenumber > 2"""
ORACLE["match_headers"] = """SELECT l_orderkey AS id_llamado, l_partkey AS codigo,
    l_linenumber AS item, CAST(NULL AS VARCHAR) AS proveedor FROM lineitem"""
ORACLE["csv_round_trip"] = """SELECT CAST(o_orderkey AS VARCHAR) AS nro_pedido,
    'Código ' || CAST(o_custkey AS VARCHAR) AS codigo,
    o_orderpriority || '; "Atención"' AS prioridad,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS estado, o_totalprice AS cantidad,
    strftime(o_orderdate, '%Y-%m-%d') AS fecha_pedido FROM orders"""

# --- write-back and synchronisation ---------------------------------------------------------


def _edits(name: str, lines: str) -> str:
    return f"""{name} AS (
  SELECT l_orderkey AS id_llamado, o_orderpriority AS licitacion,
    'C' || CAST(o_custkey AS VARCHAR) AS codigo,
    CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS item,
    CASE WHEN l_tax > 0.01 THEN l_quantity ELSE 0 END AS cantidad_solicitada,
    strftime(l_shipdate, '%Y-%m-%d') AS emitir_en, l.*,
    row(l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS age
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
  WHERE {lines} AND l_discount > 0)"""


_SAVED = "id_llamado, licitacion, codigo, item, cantidad_solicitada, emitir_en"
# Equal ages are settled by the remaining columns, higher first.
_PER_ITEM = f"""QUALIFY row_number() OVER (PARTITION BY id_llamado, licitacion, codigo, item
    ORDER BY {NEWEST}) = 1"""
ORACLE["edit_rows"] = _with(_edits("a", "true")) + f"SELECT {_SAVED} FROM a"
ORACLE["upsert_edits"] = _with(
    _edits("r", "l_returnflag <> 'A'"),
    _edits("a", "l_returnflag = 'A'"),
    f"base AS (SELECT {_SAVED}, age, 'nota ' || codigo AS comentario FROM r {_PER_ITEM})",
    f"fresh AS (SELECT {_SAVED}, age FROM a {_PER_ITEM})",
) + """SELECT id_llamado, licitacion, codigo, item,
    CASE WHEN f.n IS NULL OR f.age < b.age THEN b.cantidad_solicitada
      ELSE f.cantidad_solicitada END AS cantidad_solicitada,
    CASE WHEN f.n IS NULL OR f.age < b.age THEN b.emitir_en ELSE f.emitir_en END AS emitir_en,
    b.comentario
  FROM base b FULL JOIN (SELECT 1 AS n, * FROM fresh) f
    USING (id_llamado, licitacion, codigo, item)"""
ORACLE["upsert_contracts"] = _with(
    CONTRACTS,
    """edits AS (
  SELECT o_orderkey + CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS id_llamado,
    o_orderpriority AS licitacion, CASE WHEN o_orderstatus = 'O' THEN 'SI' ELSE 'NO' END AS vigente,
    '' AS dirigido_a, 'Depósito' AS lugares, 'obs ' || o_orderstatus AS obs
  FROM orders WHERE o_orderstatus <> 'F'
  QUALIFY row_number() OVER (PARTITION BY 1 + o_orderkey - CASE WHEN o_orderstatus = 'O' THEN 1
    ELSE 0 END ORDER BY o_orderkey DESC) = 1)""",
) + """SELECT id_llamado,
    CASE WHEN e.obs IS NULL THEN c.licitacion ELSE e.licitacion END AS licitacion,
    CASE WHEN e.obs IS NULL THEN c.vigente ELSE e.vigente END AS vigente,
    CASE WHEN e.obs IS NULL THEN c.dirigido_a ELSE e.dirigido_a END AS dirigido_a,
    CASE WHEN e.obs IS NULL THEN c.lugares ELSE e.lugares END AS lugares,
    e.obs AS observaciones_generales, c.descripcion_llamado
  FROM contracts c FULL JOIN edits e USING (id_llamado)"""
ORACLE["changed_rows"] = _with(REQUESTED) + """SELECT id_llamado, licitacion, codigo, item,
    CAST(CASE WHEN solicitada > 40 THEN solicitada + 1 ELSE solicitada END AS DOUBLE)
      AS cantidad_solicitada,
    CASE WHEN solicitada >= 5 THEN strftime(emitir_en, '%Y-%m-%d') END AS emitir_en, comentario
  FROM requested WHERE solicitada > 40 OR solicitada < 5"""
ORACLE["changed_rows_by_digest"] = ORACLE["changed_rows"]
_EVENT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props"
ORACLE["edit_log_latest"] = f"""SELECT {_EVENT} FROM events AS e
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY e.ts DESC, event_id DESC) = 1"""
ORACLE["incremental_delta"] = f"""SELECT {_EVENT} FROM events AS e
  WHERE e.ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')"""
ORACLE["incremental_stream"] = ORACLE["edit_log_latest"]
ORACLE["incremental_sync_twice"] = """SELECT event_id,
    CASE WHEN event_id % 3 > 0 THEN event_type END AS tipo, value,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS actualizado_en FROM events"""
ORACLE["sync_appended"] = """SELECT event_id, value,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS actualizado_en FROM events"""
ORACLE["load_folder_many_files"] = """SELECT CAST(o_orderkey AS VARCHAR) AS nro_pedido,
    'C' || CAST(o_custkey AS VARCHAR) AS codigo, o_orderpriority AS prioridad,
    o_orderstatus AS estado, strftime(o_orderdate, '%Y-%m-%d') AS fecha_pedido FROM orders"""
ORACLE["load_folder_all_kinds"] = """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'ordenes_apartados' ELSE 'ordenes' END AS tabla,
    'OC-' || o_orderkey AS clave, CAST(o_totalprice AS DOUBLE) AS valor FROM orders
UNION ALL SELECT 'ejecucion', 'K' || l_linenumber, l_linenumber::DOUBLE
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
UNION ALL SELECT 'stock_critico', p_partkey::VARCHAR, p_size::DOUBLE FROM part
UNION ALL SELECT 'pedidos', o_orderkey::VARCHAR, 3.0 FROM orders
UNION ALL SELECT 'vencimientos_parques', p_partkey::VARCHAR, p_size::DOUBLE FROM part"""
ORACLE["sync_content_verify"] = """WITH p AS (
  SELECT o_orderkey AS nro, 'C' || o_custkey AS codigo, o_totalprice AS monto
  FROM orders JOIN customer ON o_custkey = c_custkey),
d AS (
  SELECT nro::VARCHAR AS nro, codigo, 'cambiada' AS diferencia, 'prioridad,cantidad_pendiente' AS columnas
  FROM p WHERE monto > 490000
  UNION ALL SELECT nro::VARCHAR, codigo, 'falta', '' FROM p WHERE monto < 6000
  UNION ALL SELECT 'N' || nro, codigo, 'sobra', '' FROM p WHERE monto < 6000)
SELECT 'pedidos' AS tabla, '{"nro_pedido":"' || nro || '","codigo":"' || codigo || '"}' AS clave,
  diferencia, columnas FROM d"""
ORACLE["schema_drift"] = """SELECT l_orderkey AS id_llamado, l_linenumber::VARCHAR AS item,
    l_partkey::VARCHAR AS codigo FROM lineitem"""
ORACLE["execution_capped"] = """SELECT l_orderkey AS id_llamado, l_linenumber::VARCHAR AS item,
    l_partkey::VARCHAR AS codigo, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS monto_total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  ORDER BY CAST(l_extendedprice AS DECIMAL(18, 2)) DESC, 1 DESC, 2 DESC, 3 DESC LIMIT 15000"""
ORACLE["lower_headers"] = """SELECT o_orderkey AS id_llamado, o_orderpriority AS licitacion,
    o_orderstatus AS estado FROM orders"""
ORACLE["sync_verify"] = """WITH n AS (
  SELECT 'pedidos' AS tabla, count(*) AS origen FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'stock_critico', count(*) FROM part
  UNION ALL SELECT 'vencimientos_parques', count(*) FROM lineitem)
SELECT tabla, origen, origen AS destino, true AS coincide, CAST(0 AS BIGINT) AS diferencia FROM n"""
ORACLE["smoke_run"] = """WITH n AS (SELECT (SELECT count(*) FROM orders) AS p,
    (SELECT count(*) FROM lineitem) AS v)
SELECT 'datos de origen' AS paso, true AS ok, p + v AS registros FROM n
UNION ALL SELECT 'copia', true, p FROM n UNION ALL SELECT 'conteo', true, p FROM n
UNION ALL SELECT 'datos de destino', true, p FROM n"""
ORACLE["sync_counts"] = """WITH n AS (
  SELECT 'ejecucion' AS tabla, count(*) AS origen,
    count(DISTINCT (l_orderkey, l_linenumber)) AS destino FROM lineitem
  UNION ALL SELECT 'pedidos', count(*), count(*) FROM orders)
SELECT *, origen = destino AS coincide, origen - destino AS diferencia FROM n"""

# --- quality --------------------------------------------------------------------------------

ORACLE["quality_report"] = """SELECT 'error' AS tipo, 'vacia' AS control, '' AS columna,
    CAST(count(*) = 0 AS BIGINT) AS cantidad FROM lineitem
UNION ALL SELECT 'error', 'falta', c, n
  FROM (VALUES ('id_llamado', 0), ('codigo', 0), ('proveedor', 1)) v(c, n)
UNION ALL SELECT 'aviso', 'no_numerico', 'id_llamado', count(*) FILTER (l_returnflag = 'N')
  FROM lineitem
UNION ALL SELECT 'aviso', 'no_numerico', 'item', count(*) FILTER (l_tax > 0) FROM lineitem
UNION ALL SELECT 'aviso', 'nulos', 'id_llamado', 0
UNION ALL SELECT 'aviso', 'nulos', 'codigo', count(*) FILTER (l_discount = 0) FROM lineitem"""
ORACLE["schema_contract"] = """WITH c AS (
  SELECT count(*) FILTER (o_orderstatus = 'F') AS f,
    count(*) FILTER (length(CAST(o_custkey AS VARCHAR)) > 3) AS w
  FROM orders)
SELECT 'nro_pedido' AS columna, 'string' AS tipo, true AS presente, false AS tipo_ok,
  true AS nulos_ok, CAST(0 AS BIGINT) AS nulos, CAST(0 AS BIGINT) AS largos
UNION ALL SELECT 'codigo', 'string', true, true, true, 0, w FROM c
UNION ALL SELECT 'medicamento', 'string', true, true, true, 0, 0
UNION ALL SELECT 'cantidad_solicitada', 'decimal(18,2)', true, true, true, 0, 0
UNION ALL SELECT 'cantidad_pendiente', 'decimal(18,2)', true, true, f = 0, f, 0 FROM c
UNION ALL SELECT 'fecha_solicitud', 'date', true, true, true, 0, 0
UNION ALL SELECT 'observaciones', 'string', false, false, true, 0, 0"""
ORACLE["text_migration"] = """SELECT l_orderkey AS id_llamado,
    CAST(l_linenumber AS VARCHAR) AS item, CAST(l_partkey AS VARCHAR) AS codigo FROM lineitem"""
ORACLE["table_counts"] = """WITH n AS (
  SELECT 'ordenes' AS tabla, count(*) AS registros FROM lineitem
  UNION ALL SELECT 'ejecucion', count(*) FROM lineitem
  UNION ALL SELECT 'stock_critico', count(*) FROM part
  UNION ALL SELECT 'pedidos', count(*) FROM orders
  UNION ALL SELECT 'vencimientos_parques', count(*) FROM lineitem)
SELECT tabla, registros, CASE WHEN registros > 0 THEN 'OK' ELSE 'WARN' END AS estado FROM n
UNION ALL SELECT 'TOTAL', CAST(sum(registros) AS BIGINT), 'OK' FROM n"""
