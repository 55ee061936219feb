"""Table contracts: columns, types, keys, header synonyms and fixed word lists."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: word lists ---------------------------------------------------------------

# Cell texts that the cleaning steps treat as missing, compared after trimming.
BLANK_TOKENS = ("nan", "NaT", "None", "NaN")
# The same idea without regard to case.
NULL_WORDS = ("nan", "nat", "none", "", "null", "n/a")
# Cell texts replaced by null over a whole extract, compared untrimmed.
CELL_TOKENS = ("", " ", "NULL", "null", "None", "#N/A", "#REF!")
# Cell texts a delimited file reader takes as missing, compared untrimmed.
READER_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Order states with nothing left to deliver, lower case.
CLOSED_STATES = (
    "entregado", "finalizado", "completado", "completada", "entrega parcial", "entrega total",
)
# Stock levels, and the ones a critical list shows.
LEVELS = ("Crítico", "Atención", "Óptimo", "Sin DMP", "Sin Stock")
CRITICAL_LEVELS = ("Crítico", "Sin Stock")
# Column names that need a prefix.
RESERVED_WORDS = ("select", "insert", "update", "delete", "table", "from", "where")
# A due date that is a phrase instead of a date.
OPEN_ENDED_PHRASE = "CUMPLIMIENTO TOTAL DE LAS OBLIGACIONES"
# The measure kept from long expiry extracts, and the headers of measure name and value.
MEASURE = "STOCK DISPONIBLE"
MEASURE_NAME_HEADERS = ("Nombres de medidas", "nombres_de_medidas", "nombres de medidas")
MEASURE_VALUE_HEADERS = ("Valores de medidas", "valores_de_medidas", "valores de medidas")
# Year that marks a lot without expiry.
NO_EXPIRY_YEAR = 5000
# Orders the rows of loaded tables, the newest last: number of the batch, then file, split and place
# in the split. Not part of the extracts.
LOAD_ORDER_COLUMN = "orden_carga"
# Columns the target table fills by itself.
SELF_FILLED = ("id", "creado_en", "actualizado_en")

# --- fixed values: header synonyms ----------------------------------------------------------

ORDERS_HEADERS = {
    "Id.Llamado": "id_llamado",
    "Llamado": "llamado",
    "P.Unit.": "p_unit",
    "Fec.Contrato": "fec_contrato",
    "OC": "oc",
    "Item": "item",
    "Codigo": "codigo",
    "Código": "codigo",
    "Producto": "producto",
    "Cant. OC": "cant_oc",
    "Monto OC": "monto_oc",
    "Monto Recepcion": "monto_recepcion",
    "Monto Recepción": "monto_recepcion",
    "Monto Recepciòn": "monto_recepcion",
    "Cant. Recep.": "cant_recep",
    "Monto Saldo": "monto_saldo",
    "Dias de Atraso": "dias_de_atraso",
    "Estado": "estado",
    "Stock": "stock",
    "Referencia": "referencia",
    "Proveedor": "proveedor",
    "Lugar Entrega OC": "lugar_entrega_oc",
    "Lugar Entrega": "lugar_entrega_oc",
    "Fec. Ult. Recep.": "fec_ult_recep",
    "Fecha Recibido Proveedor": "fecha_recibido_proveedor",
    "Fecha Recibido Poveedor": "fecha_recibido_proveedor",
    "Fecha OC": "fecha_oc",
    "Saldo": "saldo",
    "Plazo Entrega": "plazo_entrega",
    "Tipo Vigencia": "tipo_vigencia",
    "Vigencia": "vigencia",
    "Det. Recep.": "det_recep",
}

EXECUTION_HEADERS = {
    "Id. Llamado": "id_llamado",
    "Id.Llamado": "id_llamado",
    "Llamado": "licitacion",
    "Licitación": "licitacion",
    "Licitacion": "licitacion",
    "Proveedor": "proveedor",
    "Codigo": "codigo",
    "Código": "codigo",
    "Medicamento": "medicamento",
    "Producto": "medicamento",
    "Item": "item",
    "Cantidad Máxima": "cantidad_maxima",
    "Cantidad Maxima": "cantidad_maxima",
    "Cantidad Emitida": "cantidad_emitida",
    "Cantidad Recepcionada": "cantidad_recepcionada",
    "Cantidad Distribuida": "cantidad_distribuida",
    "Monto Adjudicado": "monto_adjudicado",
    "Monto Emitido": "monto_emitido",
    "Saldo": "saldo",
    "Porcentaje Emitido": "porcentaje_emitido",
    "Ejecucion Mayor al 50": "ejecucion_mayor_al_50",
    "Estado Stock": "estado_stock",
    "Estado Contrato": "estado_contrato",
    "Cantidad Ampliacion": "cantidad_ampliacion",
    "Porcentaje Ampliado": "porcentaje_ampliado",
    "Porcentaje Ampliacion Emitido": "porcentaje_ampliacion_emitido",
    "Obs": "obs",
    "Observaciones": "obs",
}

STOCK_HEADERS = {
    "Codigo": "codigo",
    "Código": "codigo",
    "Producto": "producto",
    "Concentracion": "concentracion",
    "Concentración": "concentracion",
    "Forma Farmaceutica": "forma_farmaceutica",
    "Forma Farmacéutica": "forma_farmaceutica",
    "Presentacion": "presentacion",
    "Presentación": "presentacion",
    "Clasificacion": "clasificacion",
    "Clasificación": "clasificacion",
    "Meses en Movimiento": "meses_en_movimiento",
    "Cantidad Distribuida": "cantidad_distribuida",
    "Stock Actual": "stock_actual",
    "Stock Reservado": "stock_reservado",
    "Stock Disponible": "stock_disponible",
    "DMP": "dmp",
    "Estado Stock": "estado_stock",
    "Stock Hosp": "stock_hosp",
    "OC": "oc",
}

REQUESTS_HEADERS = {
    "Nro Pedido": "nro_pedido",
    "Nro. Pedido": "nro_pedido",
    "Simese": "simese",
    "SIMESE": "simese",
    "Fecha Pedido": "fecha_pedido",
    "Codigo": "codigo",
    "Código": "codigo",
    "Medicamento": "medicamento",
    "Stock": "stock",
    "DMP": "dmp",
    "Cantidad": "cantidad",
    "Meses Cantidad": "meses_cantidad",
    "Dias Transcurridos": "dias_transcurridos",
    "Estado": "estado",
    "Prioridad": "prioridad",
    "Nro OC": "nro_oc",
    "Nro. OC": "nro_oc",
    "Fecha OC": "fecha_oc",
    "Opciones": "opciones",
}

EXPIRY_HEADERS = {
    "codigo": "codigo",
    "Codigo": "codigo",
    "Código": "codigo",
    "codigo_producto": "codigo",
    "descripcion": "descripcion",
    "Descripcion": "descripcion",
    "Descripción": "descripcion",
    "nombre_producto": "descripcion",
    "producto_completo": "descripcion",
    "fec_vencimiento": "fec_vencimiento",
    "fecha_vencimiento": "fec_vencimiento",
    "Fecha Vencimiento": "fec_vencimiento",
    "Vencimiento": "fec_vencimiento",
    "stock_disponible": "stock_disponible",
    "Stock": "stock_disponible",
    "stock": "stock_disponible",
    "valores_de_medidas": "stock_disponible",
    "parque": "parque",
    "Parque": "parque",
    "nombre_sucursal": "parque",
    "observaciones": "observaciones",
    "Observaciones": "observaciones",
}

# --- fixed values: display titles of the board ----------------------------------------------

BOARD_TITLES = {
    "id_llamado": "ID Llamado",
    "licitacion": "Licitación",
    "nombre_llamado": "Nombre del Llamado",
    "codigo": "Código",
    "producto": "Producto",
    "proveedor": "Proveedor",
    "cantidad_maxima": "Cantidad máxima",
    "cantidad_emitida": "Cantidad emitida",
    "saldo_contrato": "Saldo contrato",
    "porcentaje_emitido": "% Emitido",
    "precio_unitario": "Precio unitario",
    "item": "Ítem",
    "dirigido_a": "Dirigido a",
    "lugar": "Lugar",
    "vigente": "Vigente",
    "pendiente_entrega": "Pendiente entrega",
    "stock_actual": "Stock actual",
    "dmp_actual": "DMP",
    "nivel_stock": "Nivel stock",
    "cantidad_solicitada": "Cantidad solicitada",
    "ver_en_fecha": "Ver en fecha",
    "comentario": "Comentario",
    "cobertura_meses": "Cobertura (meses)",
}

BOARD_COLUMNS = (
    "id_llamado", "licitacion", "nombre_llamado", "codigo", "producto", "proveedor",
    "cantidad_maxima", "cantidad_emitida", "saldo_contrato", "porcentaje_emitido",
    "precio_unitario", "item", "dirigido_a", "lugar", "vigente", "pendiente_entrega",
    "stock_actual", "dmp_actual", "cantidad_solicitada", "ver_en_fecha", "comentario",
    "cobertura_meses", "nivel_stock",
)
# Columns of the read-only summary table.
SUMMARY_COLUMNS = (
    "licitacion", "codigo", "producto", "cantidad_maxima", "cantidad_emitida",
    "saldo_contrato", "stock_actual", "dmp_actual", "nivel_stock", "cantidad_solicitada",
    "cobertura_meses",
)
CRITICAL_COLUMNS = (
    "licitacion", "codigo", "producto", "nivel_stock", "stock_actual", "cantidad_solicitada",
)
LOW_COVERAGE_COLUMNS = (
    "licitacion", "codigo", "producto", "cobertura_meses", "nivel_stock",
    "cantidad_solicitada",
)

# --- fixed values: table schemas ------------------------------------------------------------

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(18,4)": T.DecimalType(18, 4),
    "decimal(18,6)": T.DecimalType(18, 6),
}


def _struct(columns: str) -> T.StructType:
    """A schema from ``name type, ...``; works before there is a session."""
    out = T.StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        out = out.add(name, _TYPES[kind])
    return out


_AUDIT = "creado_en timestamp, actualizado_en timestamp"

SCHEMAS: dict[str, T.StructType] = {
    name: _struct(ddl)
    for name, ddl in {
        "ordenes": (
            "id int, id_llamado bigint, llamado string, p_unit decimal(18,6), "
            "fec_contrato string, oc string, item string, codigo string, producto string, "
            "cant_oc decimal(18,6), monto_oc decimal(18,6), monto_recepcion decimal(18,6), "
            "cant_recep decimal(18,6), monto_saldo decimal(18,6), dias_de_atraso bigint, "
            "estado string, stock string, referencia string, proveedor string, "
            "lugar_entrega_oc string, fec_ult_recep string, fecha_recibido_proveedor string, "
            "fecha_oc string, saldo decimal(18,6), plazo_entrega string, "
            "tipo_vigencia string, vigencia string, det_recep string, fecha_orden date, "
            f"fecha_vencimiento date, observaciones string, {_AUDIT}"
        ),
        "ejecucion": (
            "id int, id_llamado int, licitacion string, proveedor string, codigo string, "
            "medicamento string, item string, cantidad_maxima decimal(18,2), "
            "cantidad_emitida decimal(18,2), cantidad_recepcionada decimal(18,2), "
            "cantidad_distribuida decimal(18,2), monto_adjudicado decimal(18,2), "
            "monto_emitido decimal(18,2), saldo decimal(18,2), "
            "porcentaje_emitido decimal(18,2), ejecucion_mayor_al_50 string, "
            "estado_stock string, estado_contrato string, cantidad_ampliacion decimal(18,2), "
            "porcentaje_ampliado decimal(18,2), porcentaje_ampliacion_emitido decimal(18,2), "
            "obs string, cantidad_ejecutada decimal(18,2), precio_unitario decimal(18,4), "
            "monto_total decimal(18,2), fecha_ejecucion date, observaciones string, "
            f"{_AUDIT}"
        ),
        "datosejecucion": (
            "id_llamado int, licitacion string, llamado string, descripcion_llamado string, "
            "vigente string, dirigido_a string, lugares string, fecha_inicio date, "
            "fecha_fin date, numero_contrato string, monto_total decimal(18,2), "
            "precio_unitario decimal(18,4), observaciones_generales string, "
            f"estado_manual string, {_AUDIT}"
        ),
        "stock_critico": (
            "id int, codigo string, producto string, concentracion string, "
            "forma_farmaceutica string, presentacion string, clasificacion string, "
            "meses_en_movimiento int, cantidad_distribuida decimal(18,2), "
            "stock_actual decimal(18,2), stock_reservado decimal(18,2), "
            "stock_disponible decimal(18,2), dmp decimal(18,2), estado_stock string, "
            "stock_hosp decimal(18,2), oc string, descripcion string, "
            "stock_minimo decimal(18,2), estado string, ultima_actualizacion timestamp"
        ),
        "pedidos": (
            "id int, nro_pedido string, simese string, fecha_pedido date, codigo string, "
            "medicamento string, stock decimal(18,2), dmp decimal(18,2), "
            "cantidad decimal(18,2), meses_cantidad decimal(18,2), dias_transcurridos int, "
            "estado string, prioridad string, nro_oc string, fecha_oc date, opciones string, "
            "id_llamado int, item int, cantidad_solicitada decimal(18,2), "
            "cantidad_pendiente decimal(18,2), fecha_solicitud date, fecha_requerida date, "
            f"observaciones string, {_AUDIT}"
        ),
        "cantidad_solicitada": (
            "id_llamado int, licitacion string, codigo string, item string, "
            "cantidad_solicitada decimal(18,2), emitir_en date, comentario string, "
            "actualizado_en timestamp"
        ),
        "vencimientos_parques": (
            "id int, codigo string, descripcion string, fec_vencimiento date, "
            f"stock_disponible decimal(18,2), parque string, observaciones string, {_AUDIT}"
        ),
    }.items()
}

_PLACE = (
    T.StructType()
    .add("carga", T.LongType()).add("archivo", T.StringType()).add("bloque", T.LongType())
    .add("fila", T.LongType())
)
for _name in ("ordenes", "ejecucion", "stock_critico", "pedidos", "vencimientos_parques"):
    SCHEMAS[_name] = SCHEMAS[_name].add(LOAD_ORDER_COLUMN, _PLACE)

ITEM_KEY = ("id_llamado", "licitacion", "codigo", "item")
KEYS = {
    "ordenes": ("oc", "item", "codigo"),
    "ejecucion": ITEM_KEY,
    "datosejecucion": ("id_llamado",),
    "stock_critico": ("codigo",),
    "pedidos": ("nro_pedido", "codigo"),
    "cantidad_solicitada": ITEM_KEY,
    "vencimientos_parques": ("codigo", "parque", "fec_vencimiento"),
}
# Copy order of a full synchronisation.
SYNC_ORDER = (
    "ordenes", "ejecucion", "datosejecucion", "stock_critico", "pedidos",
    "cantidad_solicitada", "vencimientos_parques",
)
# Load order of the extracts, with the file each one is looked for first.
LOAD_ORDER = ("ordenes", "ejecucion", "stock", "pedidos", "vencimientos_parques")
# Columns that must be text whatever an older table says.
TEXT_COLUMNS = {
    "ejecucion": ("item",),
    "stock_critico": ("codigo",),
    "ordenes": ("item",),
    "pedidos": ("codigo",),
    "cantidad_solicitada": ("item",),
}
