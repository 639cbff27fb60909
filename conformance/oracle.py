"""DuckDB SQL for every registered query, on the driver's views.

``CTES`` states the fixture mapping; each query takes the CTEs it needs.
"""

from __future__ import annotations

from conformance.fixtures import PLANTED
from tenderloom.schemas import AWARD_LINES, BID_LINES, BUYERS, CATALOG, STAGING, SUPPLIERS, TENDER_LINES, Table
from tenderloom.sources.segments import SEGMENTS

BATCH = "00000000-0000-4000-8000-000000000001"


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,4)) AS VARCHAR)"


def _text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _technical(stamp: str, source: str, period: str | None = None) -> str:
    return (
        f"strftime({period or stamp}, '%Y%m') AS etl_period, '{source}' AS source_file, "
        f"{stamp} AS loaded_at, '{BATCH}' AS batch_id"
    )


CODE = "lpad(CAST(10 + l_partkey % 90 AS VARCHAR), 2, '0') || '010101' || lpad(CAST(l_partkey AS VARCHAR), 8, '0')"
BID = "CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR)"
RATE = "CAST(CAST(l_tax + 500 AS DECIMAL(18,6)) AS VARCHAR)"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTES[name] = (needs, sql)


_cte(
    "line_history",
    (),
    f"""
    SELECT l.*, o_custkey, p_name, version, {CODE} AS code, {BID} AS bid,
           CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,4)) + version AS DECIMAL(18,4)) AS VARCHAR) AS price,
           CASE WHEN version = 1 THEN l_shipdate + INTERVAL 31 DAY ELSE l_shipdate END AS stamp
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN (VALUES (0), (1)) v(version) ON version = 0 OR l_returnflag = 'R'
    """,
)
_cte(
    "stg_lineas_carteles",
    ("line_history",),
    f"""
    SELECT {_text('l_orderkey')} AS nro_sicop, {_text('l_linenumber')} AS numero_linea,
           CASE WHEN l_tax = 0 THEN '' ELSE {_text('l_linenumber')} END AS numero_partida,
           CASE WHEN l_discount = 0 THEN '' ELSE {_money('l_quantity')} END AS cantidad_solicitada,
           price AS precio_unitario_estimado,
           CASE WHEN l_linestatus = 'F' THEN 'CRC' ELSE 'USD' END AS tipo_moneda,
           CASE WHEN l_linestatus = 'F' THEN '' ELSE {RATE} END AS tipo_cambio_crc,
           CASE l_quantity WHEN 1 THEN '  ' || code || ' ' WHEN 2 THEN code || '0042' WHEN 3 THEN ''
                WHEN 4 THEN substr(code, 1, 15) ELSE code END AS codigo_identificacion,
           CASE WHEN l_tax = 0.08::DOUBLE THEN '' ELSE {_money('l_extendedprice')} END AS monto_reservado,
           CASE WHEN l_tax = 0.01::DOUBLE THEN '   ' ELSE ' ' || p_name || ' ' || l_returnflag END AS desc_linea,
           {_technical('stamp', 'DetalleLineaCartel.csv')}
    FROM line_history
    """,
)
_cte(
    "stg_carteles",
    (),
    f"""
    SELECT CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN 'X' ELSE '' END
             || {_text('o_orderkey')} AS nro_sicop,
           {_text('o_custkey')} AS cedula_institucion,
           {_day('o_orderdate')} || ' 13:14:15.678' AS fecha_publicacion,
           'LN-' || {_text('o_orderkey')} AS nro_procedimiento,
           o_orderpriority AS tipo_procedimiento, o_orderstatus AS modalidad_procedimiento,
           CASE WHEN version = 1 THEN 'Modificado' ELSE 'Publicado' END AS cartel_stat,
           CASE WHEN o_orderpriority = '1-URGENT' THEN repeat('compra urgente ', 40)
                ELSE 'Compra ' || {_text('o_orderkey')} END AS cartel_nm,
           CASE WHEN o_orderpriority = '5-LOW' THEN ''
                ELSE {_day('o_orderdate + INTERVAL 15 DAY')} || ' 10:00:00' END AS fechah_apertura,
           o_orderpriority AS clas_obj,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE {_money('o_totalprice')} END AS monto_est,
           {_technical('o_orderdate + version * INTERVAL 31 DAY', 'DetalleCarteles.csv')}
    FROM orders JOIN (VALUES (0), (1)) v(version) ON version = 0 OR o_orderstatus = 'P'
    """,
)
_cte(
    "stg_ofertas",
    (),
    f"""
    SELECT {_text('l_orderkey')} AS nro_sicop, {BID} AS nro_oferta, {_text('l_suppkey')} AS cedula_proveedor,
           {_day('l_shipdate')} || ' 08:30:00 (hora local)' AS fecha_presenta_oferta, l_returnflag AS tipo_oferta,
           {_technical('l_shipdate', 'Ofertas.csv')}
    FROM lineitem
    """,
)
_cte(
    "stg_lineas_ofertadas",
    ("line_history",),
    f"""
    SELECT {_text('l_orderkey')} AS nro_sicop,
           CASE WHEN l_tax = 0.08::DOUBLE THEN 'R' ELSE '' END || bid AS nro_oferta,
           {_text('l_linenumber')} AS nro_linea,
           CASE l_quantity WHEN 1 THEN ' ' || code || '  ' WHEN 3 THEN ''
                WHEN 4 THEN substr(code, 1, 15) ELSE code END AS codigo_producto_cl,
           {_money('l_quantity')} AS cantidad_ofertada,
           CASE WHEN l_discount = 0 THEN '' ELSE price END AS precio_unitario_ofertado,
           'CRC' AS tipo_moneda, '1' AS tipo_cambio_crc, {_technical('stamp', 'LineasOfertadas.csv')}
    FROM line_history
    """,
)
_cte(
    "stg_lineas_adjudicadas",
    ("line_history",),
    f"""
    SELECT {_text('l_orderkey')} AS nro_sicop, bid AS nro_oferta, {_text('l_linenumber')} AS nro_linea,
           CASE l_quantity WHEN 1 THEN ' ' || code WHEN 2 THEN code || '0042'
                WHEN 5 THEN 'X' || substr(code, 2, 15) ELSE code END AS codigo_producto,
           {_text('l_suppkey')} AS cedula_proveedor,
           CASE WHEN l_discount = 0.1::DOUBLE THEN '' ELSE {_money('l_quantity')} END AS cantidad_adjudicada,
           price AS precio_unitario_adjudicado, {_money('l_tax')} AS iva, '' AS otros_impuestos, '' AS acarreos,
           CASE WHEN l_linestatus = 'F' THEN 'CRC' ELSE 'USD' END AS tipo_moneda,
           CASE WHEN l_linestatus = 'F' THEN '' ELSE {RATE} END AS tipo_cambio_crc,
           {_technical('stamp', 'LineasAdjudicadas.csv')}
    FROM line_history
    """,
)
_cte(
    "stg_procedimientos_adjudicacion",
    ("line_history",),
    f"""
    SELECT {_text('l_orderkey')} AS nro_sicop, {_text('o_custkey')} AS cedula,
           'LN-' || {_text('l_orderkey')} AS numero_procedimiento,
           'Adjudicacion ' || p_name AS descr_procedimiento, {_text('l_linenumber')} AS linea,
           CASE WHEN l_returnflag = 'N' THEN '' WHEN l_quantity = 1 THEN code || ' ' ELSE code END AS prod_id,
           CASE WHEN l_tax = 0 THEN '' WHEN l_tax = 0.01::DOUBLE THEN strftime(l_shipdate, '%-d/%-m/%Y')
                ELSE strftime(l_shipdate, '%d/%m/%Y') END AS fecha_adjud_firme,
           CASE WHEN l_discount = 0 THEN '' ELSE price END AS monto_adju_linea,
           {_technical('stamp', 'ProcedimientoAdjudicacion.csv')}
    FROM line_history
    """,
)
_LOADED = "CASE WHEN version = 1 THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-02-01' END"
_cte(
    "stg_instituciones",
    (),
    f"""
    SELECT cedula, CASE WHEN version = 1 THEN upper(name) ELSE name END AS nombre_institucion, zona_geo_inst,
           '2020-01-01' AS fecha_ingreso,
           {_technical(_LOADED, 'InstitucionesRegistradas.csv',
                       "CASE WHEN version = 1 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END")}
    FROM (
        SELECT {_text('c_custkey')} AS cedula, c_mktsegment,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Institucion ' || n_name ELSE c_name END AS name,
               CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN n_name || ',' || r_name
                    WHEN 'HOUSEHOLD' THEN ' , ,' || r_name
                    ELSE c_name || ', ' || n_name || ', ' || r_name END AS zona_geo_inst
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    ) JOIN (VALUES (0), (1)) v(version) ON version = 0 OR c_mktsegment IN ('FURNITURE', 'MACHINERY')
    """,
)
_cte(
    "stg_proveedores",
    (),
    f"""
    SELECT {_text('s_suppkey')} AS cedula_proveedor,
           CASE WHEN version = 1 THEN upper(s_name) ELSE s_name END AS nombre_proveedor,
           'Juridico' AS tipo_proveedor, CASE WHEN s_acctbal > 5000 THEN 'GRANDE' ELSE 'PYME' END AS tamano,
           '2010-01-01' AS fecha_constitucion,
           CASE WHEN version = 0 THEN s_name || ', ' || n_name || ', ' || r_name END AS zona_geo_prov,
           '2020-01-01' AS fecha_registro, {_technical(_LOADED, 'Proveedores.csv')}
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN (VALUES (0), (1)) v(version) ON version = 0 OR s_acctbal < 0
    """,
)
_cte(
    "event_headers",
    (),
    f"""
    SELECT CAST(user_id AS VARCHAR) || '-' || event_type AS nro_sicop, props AS cartel_nm,
           {_money('value')} AS monto_est, strftime(ts, '%Y%m') AS etl_period, ts AS loaded_at
    FROM events
    """,
)
_cte("segmentos", (), "SELECT * FROM (VALUES " + ", ".join(f"({n}, '{t}')" for n, t in SEGMENTS) + ") s(segmento, nombre_segmento)")


def _latest(source: str, keys: list[str], rest: list[str], version=("etl_period", "loaded_at")) -> str:
    order = [f"{c} DESC NULLS FIRST" for c in version] + [f"{c} ASC NULLS FIRST" for c in rest]
    columns = [*keys, *rest, *version]
    return (
        f"SELECT {', '.join(columns)} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) = 1"
    )


_cte(
    "latest_tenders",
    ("stg_carteles",),
    _latest(
        "stg_carteles",
        ["nro_sicop"],
        "nro_procedimiento cartel_nm cartel_stat clas_obj monto_est cedula_institucion tipo_procedimiento "
        "modalidad_procedimiento fecha_publicacion fechah_apertura".split(),
    ),
)
_cte(
    "latest_tender_lines",
    ("stg_lineas_carteles",),
    _latest(
        "stg_lineas_carteles",
        ["nro_sicop", "numero_linea", "codigo_identificacion"],
        "numero_partida cantidad_solicitada precio_unitario_estimado monto_reservado tipo_moneda tipo_cambio_crc".split(),
    ),
)
_cte(
    "latest_bids",
    ("stg_ofertas",),
    _latest("stg_ofertas", ["nro_oferta"], ["cedula_proveedor", "fecha_presenta_oferta", "tipo_oferta"]),
)
_cte(
    "latest_bid_lines",
    ("stg_lineas_ofertadas",),
    _latest(
        "stg_lineas_ofertadas",
        ["nro_oferta", "nro_linea", "codigo_producto_cl"],
        "nro_sicop cantidad_ofertada precio_unitario_ofertado tipo_moneda tipo_cambio_crc".split(),
    ),
)
_cte(
    "latest_award_lines",
    ("stg_lineas_adjudicadas",),
    _latest(
        "stg_lineas_adjudicadas",
        ["nro_sicop", "nro_oferta", "nro_linea", "codigo_producto"],
        "cedula_proveedor cantidad_adjudicada precio_unitario_adjudicado tipo_moneda tipo_cambio_crc".split(),
    ),
)
_cte(
    "latest_procedures",
    ("stg_procedimientos_adjudicacion",),
    _latest(
        "stg_procedimientos_adjudicacion",
        ["nro_sicop", "linea", "prod_id"],
        "cedula numero_procedimiento descr_procedimiento fecha_adjud_firme monto_adju_linea".split(),
    ),
)


def _num(x: str, type_: str) -> str:
    return f"CAST(NULLIF({x}, '') AS {type_})"


def _amount(x: str) -> str:
    return _num(x, "DECIMAL(18,4)")


def _stamp_day(x: str) -> str:
    return f"CAST(CAST(CAST(NULLIF(substr({x}, 1, 19), '') AS TIMESTAMP) AS DATE) AS TIMESTAMP)"


def _geo(x: str) -> str:
    return ", ".join(
        f"NULLIF(trim(split_part({x}, ',', {i})), '') AS {level}"
        for i, level in enumerate(("distrito", "canton", "provincia"), start=1)
    )


_cte(
    BUYERS.name,
    ("stg_instituciones",),
    f"""
    SELECT DISTINCT ON (cedula) cedula AS cedula_institucion, nombre_institucion, {_geo('zona_geo_inst')}
    FROM stg_instituciones ORDER BY cedula, loaded_at DESC NULLS FIRST
    """,
)
_cte(
    SUPPLIERS.name,
    ("stg_proveedores",),
    f"""
    SELECT DISTINCT ON (cedula_proveedor) cedula_proveedor, nombre_proveedor, tipo_proveedor, tamano,
           {_geo('zona_geo_prov')}
    FROM stg_proveedores ORDER BY cedula_proveedor, loaded_at DESC NULLS FIRST
    """,
)
_cte(
    "raw_codes",
    ("stg_lineas_carteles", "stg_lineas_ofertadas", "stg_lineas_adjudicadas", "stg_procedimientos_adjudicacion"),
    """
    SELECT substr(trim(codigo_identificacion), 1, 16) AS cod_producto, trim(desc_linea) AS descr FROM stg_lineas_carteles
    UNION ALL SELECT substr(trim(codigo_producto_cl), 1, 16), NULL FROM stg_lineas_ofertadas
    UNION ALL SELECT substr(trim(codigo_producto), 1, 16), NULL FROM stg_lineas_adjudicadas
    UNION ALL SELECT substr(trim(prod_id), 1, 16), NULL FROM stg_procedimientos_adjudicacion
    """,
)
_cte(
    "valid_codes",
    ("raw_codes",),
    "SELECT cod_producto, NULLIF(descr, '') AS descr FROM raw_codes WHERE regexp_full_match(cod_producto, '[0-9]{16}')",
)
_cte(
    "description_counts",
    ("valid_codes",),
    "SELECT cod_producto, descr, COUNT(*) AS n FROM valid_codes WHERE descr IS NOT NULL GROUP BY ALL",
)
_cte(
    "product_names",
    ("description_counts",),
    """
    SELECT cod_producto, descr AS descripcion_producto FROM description_counts
    QUALIFY row_number() OVER (PARTITION BY cod_producto ORDER BY n DESC, descr) = 1
    """,
)
_cte(
    "commodity_names",
    ("description_counts",),
    """
    SELECT cod_mercancia, descr AS nombre_mercancia
    FROM (SELECT substr(cod_producto, 1, 8) AS cod_mercancia, descr, SUM(n) AS n FROM description_counts GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY cod_mercancia ORDER BY n DESC, descr) = 1
    """,
)
_cte(
    CATALOG.name,
    ("valid_codes", "product_names", "commodity_names", "segmentos"),
    """
    SELECT CAST(c.cod_producto AS BIGINT) AS cod_producto, left(descripcion_producto, 500) AS descripcion_producto,
           s.segmento_codigo AS segmento, nombre_segmento,
           CAST(substr(c.cod_producto, 1, 4) AS INTEGER) AS familia,
           CAST(substr(c.cod_producto, 1, 6) AS INTEGER) AS clases,
           CAST(substr(c.cod_producto, 1, 8) AS INTEGER) AS mercancias,
           left(nombre_mercancia, 255) AS nombre_mercancia
    FROM (SELECT DISTINCT cod_producto FROM valid_codes) c
    CROSS JOIN LATERAL (SELECT CAST(substr(c.cod_producto, 1, 2) AS INTEGER) AS segmento_codigo) s
    LEFT JOIN product_names USING (cod_producto)
    LEFT JOIN commodity_names ON cod_mercancia = substr(c.cod_producto, 1, 8)
    LEFT JOIN segmentos ON segmentos.segmento = s.segmento_codigo
    """,
)
_cte(
    TENDER_LINES.name,
    ("latest_tenders", "latest_tender_lines"),
    f"""
    SELECT l.nro_sicop, nro_procedimiento, concat(l.nro_sicop, '_', numero_linea) AS nro_sicop_nro_linea,
           left(cartel_nm, 500) AS nombre_cartel, cartel_stat AS status_cartel, clas_obj AS clasificacion_cartel,
           {_amount('monto_est')} AS monto_estimado_cartel_crc, {_num('numero_linea', 'INTEGER')} AS nro_linea,
           {_num('numero_partida', 'INTEGER')} AS nro_partida,
           {_num('substr(trim(codigo_identificacion), 1, 16)', 'BIGINT')} AS cod_producto,
           {_amount('cantidad_solicitada')} AS cantidad,
           {_amount('precio_unitario_estimado')} AS precio_unitario_estimado,
           {_amount('monto_reservado')} AS monto_total_linea_estimado, tipo_moneda,
           {_num('tipo_cambio_crc', 'DECIMAL(18,6)')} AS tipo_cambio_crc, cedula_institucion, tipo_procedimiento,
           modalidad_procedimiento, {_stamp_day('fecha_publicacion')} AS fecha_publicacion,
           {_stamp_day('fechah_apertura')} AS fecha_apertura
    FROM latest_tender_lines l LEFT JOIN latest_tenders c ON l.nro_sicop = c.nro_sicop
    """,
)
_cte(
    BID_LINES.name,
    ("latest_bids", "latest_bid_lines"),
    f"""
    SELECT concat(l.nro_oferta, '_', nro_linea) AS nro_oferta_nro_linea, cedula_proveedor,
           {_stamp_day('fecha_presenta_oferta')} AS fecha_oferta_presentada, tipo_oferta, l.nro_oferta,
           {_num('trim(codigo_producto_cl)', 'BIGINT')} AS cod_producto, nro_sicop,
           {_num('nro_linea', 'INTEGER')} AS nro_linea, concat(nro_sicop, '_', nro_linea) AS nro_sicop_nro_linea,
           {_amount('cantidad_ofertada')} AS cantidad_ofertada,
           {_amount('precio_unitario_ofertado')} AS precio_unitario_ofertado, tipo_moneda,
           {_num('tipo_cambio_crc', 'DECIMAL(18,6)')} AS tipo_cambio_crc
    FROM latest_bid_lines l LEFT JOIN latest_bids o ON l.nro_oferta = o.nro_oferta
    """,
)
_cte(
    AWARD_LINES.name,
    ("latest_award_lines", "latest_procedures"),
    f"""
    SELECT concat(l.nro_sicop, '_', nro_linea) AS nro_sicop_nro_linea, l.nro_sicop, nro_oferta,
           numero_procedimiento AS nro_procedimiento, {_num('nro_linea', 'INTEGER')} AS nro_linea,
           left(descr_procedimiento, 500) AS descr_procedimiento, {_amount('cantidad_adjudicada')} AS cantidad_adjudicada,
           {_amount('precio_unitario_adjudicado')} AS precio_unitario_adjudicado,
           {_amount('monto_adju_linea')} AS monto_adjudicado_linea, cedula AS cedula_institucion,
           CAST(strptime(NULLIF(fecha_adjud_firme, ''), '%d/%m/%Y') AS DATE) AS fecha_adjud_firme, cedula_proveedor,
           {_num('trim(prod_id)', 'BIGINT')} AS cod_producto, tipo_moneda AS moneda_adjudicada,
           {_num('tipo_cambio_crc', 'DECIMAL(18,6)')} AS tipo_cambio_crc
    FROM latest_award_lines l LEFT JOIN latest_procedures p
      ON l.nro_sicop = p.nro_sicop AND nro_linea = linea AND substr(trim(codigo_producto), 1, 16) = trim(prod_id)
    """,
)


FACTS = (TENDER_LINES, BID_LINES, AWARD_LINES)
for _fact in FACTS:
    _new = ", ".join(
        f"CAST(CASE WHEN {where} THEN {value} ELSE {column} END AS "
        f"{ {c.name: c.type for c in _fact.columns}[column].replace('string', 'VARCHAR') }) AS {column}"
        for column, where, value in PLANTED[_fact.name]
    )
    _cte(f"planted_{_fact.name}", (_fact.name,), f"SELECT * REPLACE ({_new}) FROM {_fact.name}")


def _with(needs: tuple[str, ...] | list[str], body: str) -> str:
    """``body`` behind the CTEs it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dependency in CTES[name][0]:
            visit(dependency)
        ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in ordered) + "\n" + body.strip()


def _all(name: str, columns: str = "*") -> str:
    return _with((name,), f"SELECT {columns} FROM {name}")


def _duplicates(table: Table, keys: tuple[str, ...], prefix: str = "") -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    key = ", ".join(keys)
    return f"""
        SELECT f.*, n_rows FROM {prefix}{table.name} f
        JOIN (SELECT {key}, COUNT(*) AS n_rows FROM {prefix}{table.name} WHERE {present} GROUP BY {key} HAVING COUNT(*) > 1) d
        USING ({key})
        """


def _row_rules(table: Table, kinds: tuple[str, ...] = ("not_null", "length", "check")) -> list[tuple[str, str, str]]:
    """(rule, target, condition that breaks it)"""
    rules = []
    if "not_null" in kinds:
        rules += [("not_null", c, f"{c} IS NULL") for c in table.required]
    if "length" in kinds:
        rules += [("length", c, f"length({c}) > {n}") for c, n in table.lengths.items()]
    if "check" in kinds:
        rules += [("check", name, " OR ".join(f"{c} < 0" for c in columns)) for name, columns in table.nonnegative]
    return rules


def _present(columns: tuple[str, ...]) -> str:
    return " AND ".join(f"f.{c} IS NOT NULL" for c in columns)


def _orphans(table: Table, i: int, select: str = "f.*") -> str:
    fk = table.foreign_keys[i]
    match = " AND ".join(f"p.{r} = f.{c}" for r, c in zip(fk.ref_columns, fk.columns))
    return (
        f"SELECT {select} FROM {table.name} f WHERE {_present(fk.columns)} "
        f"AND NOT EXISTS (SELECT 1 FROM {fk.table} p WHERE {match})"
    )


def _orphan_test(table: Table, i: int, prefix: str = "planted_") -> str:
    """Whether row f has a complete reference that the parent lacks; facts among the parents are planted too."""
    fk = table.foreign_keys[i]
    match = " AND ".join(f"p.{r} = f.{c}" for r, c in zip(fk.ref_columns, fk.columns))
    parent = f"{prefix}{fk.table}" if fk.table in [t.name for t in FACTS] else fk.table
    return f"({_present(fk.columns)} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match}))"


def _kinds(table: Table) -> str:
    """How many kinds of rules row f breaks: each key and reference is a kind, and so are not_null, length and check."""
    tests = [
        " OR ".join(f"coalesce({broken}, false)" for _, _, broken in rules)
        for kind in ("not_null", "length", "check")
        if (rules := _row_rules(table, (kind,)))
    ]
    for keys in (table.primary_key, table.unique):
        if keys:
            same = " AND ".join(f"d.{k} = f.{k}" for k in keys)
            tests.append(f"(SELECT COUNT(*) FROM planted_{table.name} d WHERE {same}) > 1")
    tests += [_orphan_test(table, i) for i in range(len(table.foreign_keys))]
    return "(" + " + ".join(f"CASE WHEN {t} THEN 1 ELSE 0 END" for t in tests) + ")"


def _reasons(table: Table) -> str:
    """The rules that row f breaks, each with its columns and limit."""
    tests = [(f"{rule} {target}" + (f" > {table.lengths[target]}" if rule == "length" else ""), broken)
             for rule, target, broken in _row_rules(table)]
    for rule, keys in (("primary_key", table.primary_key), ("unique", table.unique)):
        if keys:
            same = " AND ".join(f"d.{k} = f.{k}" for k in keys)
            tests.append((f"{rule} {'+'.join(keys)}", f"(SELECT COUNT(*) FROM planted_{table.name} d WHERE {same}) > 1"))
    tests += [(fk.name, _orphan_test(table, i)) for i, fk in enumerate(table.foreign_keys)]
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {t} THEN '{reason}' END" for reason, t in tests) + ")"


def _report_lines(t: Table, prefix: str = "") -> list[str]:
    """Counts of all rows and of those that break each rule."""
    name = f"{prefix}{t.name}"

    def line(rule: str, target: str, count: str) -> str:
        return f"SELECT '{t.name}' AS table_name, '{rule}' AS rule, '{target}' AS target, n_rows FROM ({count})"

    lines = [line("rows", t.name, f"SELECT COUNT(*) AS n_rows FROM {name}")]
    for rule, target, broken in _row_rules(t):
        lines.append(line(rule, target, f"SELECT COUNT(*) AS n_rows FROM {name} WHERE {broken}"))
    for rule, keys in (("primary_key", t.primary_key), ("unique", t.unique)):
        if keys:
            count = f"SELECT COUNT(*) AS n_rows FROM ({_duplicates(t, keys, prefix)})"
            lines.append(line(rule, "+".join(keys), count))
    for i, fk in enumerate(t.foreign_keys):
        lines.append(line("foreign_key", fk.name, f"SELECT COUNT(*) AS n_rows FROM {name} f WHERE {_orphan_test(t, i, prefix)}"))
    return lines


def _refresh_summary() -> str:
    tables = (SUPPLIERS, BUYERS, CATALOG, TENDER_LINES, BID_LINES, AWARD_LINES)
    parts = [line for t in tables for line in _report_lines(t)]
    body = "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE rule = 'rows' OR n_rows > 0"
    return _with([t.name for t in tables], body)


def _planted_with(body: str) -> str:
    return _with([*(f"planted_{t.name}" for t in FACTS), BUYERS.name, SUPPLIERS.name, CATALOG.name], body)


def _same_key(a: str, b: str, keys: tuple[str, ...]) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


def _stored_bids() -> str:
    return f"SELECT * REPLACE (CASE WHEN nro_linea <> 6 THEN nro_oferta END AS nro_oferta) FROM {BID_LINES.name}"


def _incoming_bids() -> str:
    twice = "CAST(cantidad_ofertada * 2 AS DECIMAL(18,4)) AS cantidad_ofertada"
    return f"SELECT * REPLACE ({twice}) FROM ({_stored_bids()}) WHERE EXTRACT(YEAR FROM fecha_oferta_presentada) = 1996"


def _payload(name: str) -> str:
    return ", ".join(c for c in STAGING[name].names[:-4])


_AWARDS = f"""
    SELECT {_text('l_orderkey')} AS nro_sicop, CAST(l_extendedprice AS DECIMAL(18,4)) AS amount,
           {_text('o_custkey')} AS buyer, {_text('l_suppkey')} AS supplier
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
_TOTALS = (
    "COUNT(DISTINCT nro_sicop) AS carteles_ganados, "
    "CAST(SUM(amount) AS DECIMAL(38,4)) AS monto_total_adjudicado"
)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    line_keys = "nro_sicop, numero_linea, codigo_identificacion, etl_period"
    return {
        "supplier_buyer_ranking": f"""
            SELECT supplier AS cedula_proveedor, s_name AS nombre_proveedor, c_name AS nombre_institucion, {_TOTALS}
            FROM ({_AWARDS}) JOIN customer ON buyer = {_text('c_custkey')}
            JOIN supplier s ON supplier = {_text('s_suppkey')}
            GROUP BY ALL ORDER BY monto_total_adjudicado DESC NULLS FIRST""",
        "awards_by_buyer_for_supplier": f"""
            SELECT c_name AS nombre_institucion, {_TOTALS}
            FROM ({_AWARDS}) JOIN customer ON buyer = {_text('c_custkey')} WHERE supplier = '7'
            GROUP BY ALL ORDER BY monto_total_adjudicado DESC NULLS FIRST""",
        "top_buyers_by_month": """
            SELECT c_name AS nombre_institucion, COUNT(DISTINCT l_orderkey) AS carteles_publicados
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            WHERE EXTRACT(MONTH FROM o_orderdate) = 1 AND EXTRACT(YEAR FROM o_orderdate) = 1996
            GROUP BY ALL ORDER BY carteles_publicados DESC, nombre_institucion LIMIT 20""",
        "model_supplier_buyer_ranking": _with(
            (AWARD_LINES.name, BUYERS.name, SUPPLIERS.name),
            f"""
            SELECT cedula_proveedor, nombre_proveedor, nombre_institucion,
                   COUNT(DISTINCT nro_sicop) AS carteles_ganados,
                   CAST(SUM(monto_adjudicado_linea) AS DECIMAL(38,4)) AS monto_total_adjudicado
            FROM {AWARD_LINES.name} JOIN {BUYERS.name} USING (cedula_institucion)
            JOIN {SUPPLIERS.name} USING (cedula_proveedor)
            GROUP BY ALL ORDER BY monto_total_adjudicado DESC NULLS FIRST""",
        ),
        "model_awards_by_buyer": _with(
            (AWARD_LINES.name, BUYERS.name),
            f"""
            SELECT nombre_institucion, COUNT(DISTINCT nro_sicop) AS carteles_ganados,
                   CAST(SUM(monto_adjudicado_linea) AS DECIMAL(38,4)) AS monto_total_adjudicado
            FROM {AWARD_LINES.name} JOIN {BUYERS.name} USING (cedula_institucion) WHERE cedula_proveedor = '7'
            GROUP BY ALL ORDER BY monto_total_adjudicado DESC NULLS FIRST""",
        ),
        "model_top_buyers": _with(
            (TENDER_LINES.name, BUYERS.name),
            f"""
            SELECT nombre_institucion, COUNT(DISTINCT nro_sicop) AS carteles_publicados
            FROM {TENDER_LINES.name} JOIN {BUYERS.name} USING (cedula_institucion)
            WHERE EXTRACT(MONTH FROM fecha_publicacion) = 1 AND EXTRACT(YEAR FROM fecha_publicacion) = 1996
            GROUP BY ALL ORDER BY carteles_publicados DESC, nombre_institucion LIMIT 20""",
        ),
        "merged_tenders_by_supplier": f"""
            SELECT supplier AS cedula_proveedor, COUNT(DISTINCT nro_sicop) AS carteles FROM ({_AWARDS}) GROUP BY ALL""",
        "sketched_tenders_by_supplier": f"""
            SELECT supplier AS cedula_proveedor, COUNT(DISTINCT nro_sicop) AS carteles, true AS within_error
            FROM ({_AWARDS}) GROUP BY ALL""",
        "upsert_stored": _all(BUYERS.name),
        "upsert_fact": _with(
            (BID_LINES.name,),
            f"""
            SELECT * FROM ({_stored_bids()}) s
            WHERE NOT EXISTS (SELECT 1 FROM ({_incoming_bids()}) i WHERE {_same_key("i", "s", BID_LINES.primary_key)})
            UNION ALL SELECT * FROM ({_incoming_bids()})""",
        ),
        "staging_append_twice": _with(
            ("stg_carteles",),
            f"""
            SELECT {_payload('stg_carteles')}, etl_period, '{BATCH}' AS batch_id FROM stg_carteles
            UNION ALL SELECT {_payload('stg_carteles')}, etl_period, '{BATCH}' FROM stg_carteles""",
        ),
        "archive_window_moves": _with(
            ("stg_lineas_ofertadas",),
            f"SELECT {_payload('stg_lineas_ofertadas')}, etl_period, '{BATCH}' AS batch_id FROM stg_lineas_ofertadas",
        ),
        "scalar_text": _with(
            ("stg_lineas_carteles",),
            f"""
            SELECT {line_keys}, trim(desc_linea) AS trimmed, substr(trim(codigo_identificacion), 1, 16) AS code,
                   NULLIF(trim(desc_linea), '') AS descr, left(desc_linea, 5) AS first_chars
            FROM stg_lineas_carteles""",
        ),
        "composite_key": _with(
            ("stg_lineas_ofertadas",),
            """
            SELECT nro_oferta, nro_linea, concat(nro_oferta, '_', nro_linea) AS nro_oferta_nro_linea,
                   concat(nro_sicop, '_', NULLIF(precio_unitario_ofertado, '')) AS key_with_gaps
            FROM stg_lineas_ofertadas""",
        ),
        "geo_split": _with(
            ("stg_instituciones", "stg_proveedores"),
            f"""
            SELECT cedula, {_geo('zona_geo_inst')} FROM stg_instituciones
            UNION ALL SELECT cedula_proveedor, {_geo('zona_geo_prov')} FROM stg_proveedores""",
        ),
        "typed_cast": _with(
            ("stg_lineas_carteles",),
            f"""
            SELECT {line_keys}, {_num('numero_linea', 'INTEGER')} AS nro_linea,
                   {_num('numero_partida', 'INTEGER')} AS nro_partida,
                   {_amount('cantidad_solicitada')} AS cantidad, {_num('tipo_cambio_crc', 'DECIMAL(18,6)')} AS cambio,
                   {_num('substr(trim(codigo_identificacion), 1, 16)', 'BIGINT')} AS cod_producto
            FROM stg_lineas_carteles""",
        ),
        "rejected_casts": _with(
            ("stg_lineas_adjudicadas",),
            """
            SELECT nro_sicop, nro_oferta, nro_linea, codigo_producto, etl_period,
                   TRY_CAST(NULLIF(trim(codigo_producto), '') AS BIGINT) AS cod_producto
            FROM stg_lineas_adjudicadas
            WHERE trim(codigo_producto) <> '' AND TRY_CAST(trim(codigo_producto) AS BIGINT) IS NULL""",
        ),
        "parse_dates": _with(
            ("stg_carteles", "stg_procedimientos_adjudicacion"),
            f"""
            SELECT nro_sicop AS id, etl_period, {_stamp_day('fecha_publicacion')} AS first_day,
                   {_stamp_day('fechah_apertura')} AS second_day FROM stg_carteles
            UNION ALL
            SELECT nro_sicop || '_' || linea, etl_period, NULL,
                   CAST(CAST(strptime(NULLIF(fecha_adjud_firme, ''), '%d/%m/%Y') AS DATE) AS TIMESTAMP)
            FROM stg_procedimientos_adjudicacion""",
        ),
        "product_hierarchy": _with(
            ("valid_codes",),
            """
            SELECT cod_producto, CAST(substr(cod_producto, 1, 2) AS INTEGER) AS segmento,
                   CAST(substr(cod_producto, 1, 4) AS INTEGER) AS familia,
                   CAST(substr(cod_producto, 1, 6) AS INTEGER) AS clases,
                   CAST(substr(cod_producto, 1, 8) AS INTEGER) AS mercancias
            FROM (SELECT DISTINCT cod_producto FROM valid_codes)""",
        ),
        "segment_lookup": _with(
            ("valid_codes", "segmentos"),
            """
            SELECT segmento, nombre_segmento, COUNT(*) AS n_rows
            FROM (SELECT CAST(substr(cod_producto, 1, 2) AS INTEGER) AS segmento FROM valid_codes)
            LEFT JOIN segmentos USING (segmento) GROUP BY ALL""",
        ),
        "latest_header": _with(
            ("event_headers",), _latest("event_headers", ["nro_sicop"], ["cartel_nm", "monto_est"])
        ),
        "latest_tender": _all("latest_tenders"),
        "latest_bid": _all("latest_bids"),
        "latest_line": _all("latest_tender_lines"),
        "latest_bid_line": _all("latest_bid_lines"),
        "latest_award_line": _all("latest_award_lines"),
        "latest_procedure": _all("latest_procedures"),
        "latest_supplier_dim": _with(
            ("stg_proveedores",),
            """
            SELECT DISTINCT ON (cedula_proveedor) cedula_proveedor, nombre_proveedor, tipo_proveedor, tamano,
                   zona_geo_prov, loaded_at
            FROM stg_proveedores ORDER BY cedula_proveedor, loaded_at DESC NULLS FIRST""",
        ),
        "latest_buyer_dim": _with(
            ("stg_instituciones",),
            """
            SELECT DISTINCT ON (cedula) cedula AS cedula_institucion, nombre_institucion, zona_geo_inst, loaded_at
            FROM stg_instituciones ORDER BY cedula, loaded_at DESC NULLS FIRST""",
        ),
        "upsert_latest": _with(
            ("stg_lineas_carteles",),
            _latest(
                "stg_lineas_carteles",
                ["nro_sicop", "numero_linea", "codigo_identificacion"],
                ["precio_unitario_estimado", "tipo_moneda", "desc_linea"],
            ),
        ),
        "product_codes_union": _with(
            ("raw_codes",), "SELECT cod_producto, descr, COUNT(*) AS n FROM raw_codes GROUP BY ALL"
        ),
        "valid_product_codes": _all("valid_codes"),
        "distinct_product_codes": _with(("valid_codes",), "SELECT DISTINCT cod_producto FROM valid_codes"),
        "description_counts": _all("description_counts"),
        "product_mode": _all("product_names"),
        "commodity_mode": _all("commodity_names"),
        "build_supplier_dim": _all(SUPPLIERS.name),
        "build_buyer_dim": _all(BUYERS.name),
        "build_product_catalog": _all(CATALOG.name),
        "build_tender_lines": _all(TENDER_LINES.name),
        "build_bid_lines": _all(BID_LINES.name),
        "build_award_lines": _all(AWARD_LINES.name),
        "incremental_tender_lines": _all(TENDER_LINES.name),
        "incremental_bid_lines": _all(BID_LINES.name),
        "incremental_award_lines": _all(AWARD_LINES.name),
        "incremental_catalog": _all(CATALOG.name),
        "pk_violations": _with((TENDER_LINES.name,), _duplicates(TENDER_LINES, TENDER_LINES.primary_key)),
        "unique_violations": _with((BID_LINES.name,), _duplicates(BID_LINES, BID_LINES.unique)),
        "not_null_violations": _with(
            (AWARD_LINES.name, TENDER_LINES.name),
            # Buyers of unmatched award lines and opening dates are made required for the check.
            _union(
                [
                    f"SELECT nro_sicop, nro_linea, '{c}' AS column_name FROM {t.name} WHERE {c} IS NULL"
                    for t, c in (
                        *((AWARD_LINES, c) for c in (*AWARD_LINES.required, "cedula_institucion")),
                        *((TENDER_LINES, c) for c in (*TENDER_LINES.required, "fecha_apertura")),
                    )
                ]
            ),
        ),
        "length_violations": _planted_with(
            _union(
                [
                    f"SELECT '{t.name}' AS table_name, nro_sicop, nro_linea, '{c}' AS column_name, "
                    f"CAST(length({c}) AS INTEGER) AS n_chars, {n} AS max_chars FROM planted_{t.name} WHERE length({c}) > {n}"
                    for t in FACTS
                    for c, n in t.lengths.items()
                ]
            ),
        ),
        "check_nonnegative": _planted_with(
            _union(
                [
                    f"SELECT '{t.name}' AS table_name, nro_sicop, nro_linea, '{target}' AS check_name "
                    f"FROM planted_{t.name} WHERE {broken}"
                    for t in FACTS
                    for _, target, broken in _row_rules(t, ("check",))
                ]
            ),
        ),
        "fk_orphans": _planted_with(
            _union(
                [
                    f"SELECT '{t.name}' AS table_name, '{fk.name}' AS reference, nro_sicop, nro_linea, "
                    f"CAST({fk.columns[0]} AS VARCHAR) AS missing FROM planted_{t.name} f WHERE {_orphan_test(t, i)}"
                    for t in FACTS
                    for i, fk in enumerate(t.foreign_keys)
                    if len(fk.columns) == 1
                ]
            ),
        ),
        "contract_report": _planted_with(
            "SELECT * FROM ("
            + _union([line for t in FACTS for line in _report_lines(t, "planted_")])
            + ") WHERE rule = 'rows' OR n_rows > 0"
        ),
        "quarantine_clean": _planted_with(
            _union(
                [
                    f"SELECT '{t.name}' AS table_name, nro_sicop, nro_linea, cod_producto FROM planted_{t.name} f "
                    f"WHERE {_kinds(t)} = 0"
                    for t in FACTS
                ]
            ),
        ),
        "quarantine_rejects": _planted_with(
            _union(
                [
                    f"SELECT '{t.name}' AS table_name, nro_sicop, nro_linea, cod_producto, {_kinds(t)} AS n_kinds "
                    f"FROM planted_{t.name} f WHERE {_kinds(t)} > 0"
                    for t in FACTS
                ]
            ),
        ),
        "quarantine_reasons": _planted_with(
            "SELECT * FROM ("
            + _union(
                [
                    f"SELECT '{t.name}' AS table_name, nro_sicop, nro_linea, cod_producto, {_reasons(t)} AS reasons "
                    f"FROM planted_{t.name} f"
                    for t in FACTS
                ]
            )
            + ") WHERE reasons <> ''"
        ),
        "fk_orphans_composite": _with(
            (AWARD_LINES.name, BID_LINES.name),
            _orphans(AWARD_LINES, 0, "nro_sicop, nro_oferta, nro_linea, cod_producto"),
        ),
        "last_n_periods": _with(
            ("stg_lineas_carteles",),
            f"SELECT {_payload('stg_lineas_carteles')}, etl_period FROM stg_lineas_carteles "
            "WHERE etl_period BETWEEN '199806' AND '199812'",
        ),
        "csv_staging_scan": _with(
            ("stg_lineas_carteles",),
            "SELECT nro_sicop, numero_linea, codigo_identificacion, desc_linea, monto_reservado FROM stg_lineas_carteles",
        ),
        "stamp_metadata": _with(
            ("stg_carteles",),
            f"SELECT {_payload('stg_carteles')}, etl_period, '{BATCH}' AS batch_id FROM stg_carteles",
        ),
        "staging_append_stream": _with(
            ("stg_carteles",),
            f"SELECT {_payload('stg_carteles')}, etl_period, '{BATCH}' AS batch_id FROM stg_carteles",
        ),
        "archive_ingest": _with(
            ("stg_lineas_ofertadas",),
            f"SELECT {_payload('stg_lineas_ofertadas')}, etl_period, '{BATCH}' AS batch_id FROM stg_lineas_ofertadas",
        ),
        "archive_append_stream": _with(
            ("stg_lineas_ofertadas",),
            f"SELECT {_payload('stg_lineas_ofertadas')}, etl_period, '{BATCH}' AS batch_id FROM stg_lineas_ofertadas "
            "WHERE etl_period BETWEEN '199806' AND '199812'",
        ),
        "full_refresh_summary": _refresh_summary(),
    }
