"""Table layouts, and the names the result tables are published under."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _layout(*columns: tuple) -> T.StructType:
    fields = []
    for name, kind, *rest in columns:
        fields.append(T.StructField(name, kind, bool(rest and rest[0])))
    return T.StructType(fields)


_LONG, _INT, _TEXT, _DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
_PRICE, _AMOUNT = T.DecimalType(10, 2), T.DecimalType(20, 2)

# A third entry of True marks a column that may be NULL.
PRODUCTS = _layout(
    ("product_id", _LONG), ("product_name", _TEXT), ("price", _PRICE),
    ("frequency", _TEXT, True), ("category", _TEXT),
)
TICKETS = _layout(
    ("ticket_id", _LONG), ("sold_at", T.TimestampType()), ("external_uuid", _TEXT),
    ("total_amount", _AMOUNT), ("total_quantity", _LONG),
)
LINES = _layout(
    ("ticket_id", _LONG), ("product_id", _LONG), ("quantity", _LONG), ("amount", _PRICE),
)
DIM_TIME = _layout(
    ("date_key", _INT), ("date", T.DateType()), ("year", _INT), ("month", _INT), ("day", _INT),
    ("day_of_week", _INT), ("month_name", _TEXT), ("day_name", _TEXT), ("quarter", _INT),
    ("week", _INT), ("is_weekend", _INT), ("period", _TEXT), ("season", _TEXT),
)
DIM_PRODUCT = _layout(
    ("product_key", _LONG), ("product_id", _LONG), ("product_name", _TEXT),
    ("category", _TEXT), ("price", _PRICE),
)
DIM_CUSTOMER = _layout(("customer_key", _LONG), ("customer_type", _TEXT))
FACT_SALES = _layout(
    ("date_key", _INT), ("product_key", _LONG), ("customer_key", _LONG), ("ticket_id", _LONG),
    ("quantity", _LONG), ("amount", _PRICE), ("ticket_total", _AMOUNT), ("ticket_quantity", _LONG),
)
PAIRS = _layout(
    ("product_a", _LONG), ("product_b", _LONG), ("hash_a", _TEXT), ("hash_b", _TEXT),
    ("support", _LONG), ("support_a", _LONG), ("support_b", _LONG),
    ("confidence_ab", _DOUBLE), ("confidence_ba", _DOUBLE), ("lift", _DOUBLE),
    ("jaccard", _DOUBLE, True), ("category_a", _TEXT), ("category_b", _TEXT),
)
CATEGORY_PAIRS = _layout(
    ("category_a", _TEXT), ("category_b", _TEXT), ("support", _LONG), ("n_tickets", _LONG),
    ("score", _DOUBLE), ("priority", _TEXT), ("peak_season", _TEXT, True),
)
RECOMMENDATIONS = _layout(
    ("trigger_product", _LONG), ("recommended_product", _LONG), ("kind", _TEXT),
    ("score", _DOUBLE), ("probability", _DOUBLE), ("uplift", _PRICE),
    ("message", _TEXT), ("source", _TEXT),
)
ANOMALIES = _layout(("ticket_id", _LONG), ("kind", _TEXT), ("score", _DOUBLE), ("message", _TEXT))
BUNDLES = _layout(
    ("product_a", _LONG), ("product_b", _LONG), ("bundle_name", _TEXT), ("products", _TEXT),
    ("kind", _TEXT), ("potential", T.DecimalType(22, 4)),
)
ITEMSETS = _layout(
    ("items", T.ArrayType(_LONG)), ("itemset_text", _TEXT), ("itemset_hash", _TEXT),
    ("size", _INT), ("support", _LONG), ("relative_support", _DOUBLE),
)
RULES = _layout(
    ("antecedent_text", _TEXT), ("consequent_text", _TEXT),
    ("antecedent_hash", _TEXT), ("consequent_hash", _TEXT),
    ("support", _LONG), ("relative_support", _DOUBLE), ("confidence", _DOUBLE), ("lift", _DOUBLE),
    ("conviction", _DOUBLE), ("leverage", _DOUBLE, True), ("source", _TEXT),
)
COMPARISON = _layout(
    ("product_a", _LONG), ("product_b", _LONG), ("confidence_basket", _DOUBLE, True),
    ("confidence_rules", _DOUBLE, True), ("lift_basket", _DOUBLE, True), ("lift_rules", _DOUBLE, True),
    ("delta_confidence", _DOUBLE, True), ("delta_lift", _DOUBLE, True), ("winner", _TEXT, True),
)

# Column defaults of the rule table.
RULE_DEFAULTS = {"conviction": 999999.0, "source": "APRIORI"}

# Table and column names that existing consumers read.
PUBLISHED = {
    "products": ("Productos", {
        "product_id": "Identificador", "product_name": "Producto", "price": "Precio",
        "frequency": "Frecuencia", "category": "categoria",
    }),
    "tickets": ("Tickets", {
        "ticket_id": "id", "sold_at": "fecha", "external_uuid": "external_uuid",
        "total_amount": "monto_total", "total_quantity": "cantidad_productos_vendidos",
    }),
    "lines": ("Transacciones", {
        "line_id": "id", "ticket_id": "id_ticket", "product_id": "producto_id",
        "quantity": "cantidad_productos", "amount": "precio_venta",
    }),
    "dim_time": ("dim_tiempo", {
        "date_key": "fecha_key", "date": "fecha", "year": "anio", "month": "mes", "day": "dia",
        "day_of_week": "dia_semana", "month_name": "nombre_mes", "day_name": "nombre_dia_semana",
        "quarter": "trimestre", "week": "semana_anio", "is_weekend": "es_fin_semana",
        "period": "periodo_anio", "season": "temporada",
    }),
    "dim_product": ("dim_producto", {
        "product_key": "producto_key", "product_id": "producto_id",
        "product_name": "nombre_producto", "category": "categoria", "price": "precio_actual",
    }),
    "dim_customer": ("dim_cliente", {"customer_key": "cliente_key", "customer_type": "tipo_cliente"}),
    "fact_sales": ("fact_ventas", {
        "date_key": "fecha_key", "product_key": "producto_key", "customer_key": "cliente_key",
        "ticket_id": "ticket_id", "quantity": "cantidad_vendida", "amount": "precio_total",
        "ticket_total": "monto_total_ticket", "ticket_quantity": "cantidad_productos_en_ticket",
    }),
    "basket": ("market_basket_analysis", {
        "product_a": "producto_a_key", "product_b": "producto_b_key", "hash_a": "producto_a_hash",
        "hash_b": "producto_b_hash", "support": "soporte_conjunto", "support_a": "soporte_a",
        "support_b": "soporte_b", "confidence_ab": "confianza_a_b", "confidence_ba": "confianza_b_a",
        "lift": "lift", "jaccard": "jaccard_index", "category_a": "categoria_a",
        "category_b": "categoria_b", "name_a": "nombre_a", "name_b": "nombre_b",
        "run_date": "fecha_calculo",
    }),
    "category": ("categoria_proximidad", {
        "category_a": "categoria_a", "category_b": "categoria_b", "support": "frecuencia_conjunta",
        "n_tickets": "total_transacciones", "score": "score_proximidad",
        "priority": "nivel_prioridad", "peak_season": "temporada_peak", "run_date": "fecha_analisis",
    }),
    "recommendations": ("patron_recomendaciones", {
        "trigger_product": "producto_trigger_key", "recommended_product": "producto_recomendado_key",
        "kind": "tipo_recomendacion", "score": "score_recomendacion",
        "probability": "probabilidad_compra", "uplift": "incremento_ticket_promedio",
        "message": "mensaje_recomendacion", "source": "fuente",
        "trigger_name": "trigger_nombre", "recommended_name": "recomendado_nombre",
        "run_date": "fecha_creacion",
    }),
    "anomalies": ("deteccion_anomalias", {
        "ticket_id": "ticket_id", "kind": "tipo_anomalia", "score": "score_anomalia",
        "message": "descripcion_anomalia",
    }),
    "bundles": ("oportunidades_bundling", {
        "bundle_name": "nombre_bundle", "products": "productos_bundle", "kind": "tipo_bundle",
        "potential": "potencial_incremento", "product_a": "producto_a_key",
        "product_b": "producto_b_key",
    }),
    "itemsets": ("frecuentes_apriori", {
        "itemset_text": "itemset_text", "itemset_hash": "itemset_hash", "size": "tam_itemset",
        "support": "soporte_abs", "relative_support": "soporte_rel", "run_date": "fecha_calculo",
    }),
    "rules": ("reglas_apriori", {
        "antecedent_text": "antecedente_text", "consequent_text": "consecuente_text",
        "antecedent_hash": "antecedente_hash", "consequent_hash": "consecuente_hash",
        "support": "soporte_abs", "relative_support": "soporte_rel", "confidence": "confianza",
        "lift": "lift", "conviction": "conviccion", "leverage": "leverage", "source": "fuente",
        "run_date": "fecha_calculo",
    }),
    "comparison": ("comparativo_mba_apriori", {
        "product_a": "producto_a_key", "product_b": "producto_b_key", "confidence_basket": "conf_mba",
        "confidence_rules": "conf_apriori", "lift_basket": "lift_mba", "lift_rules": "lift_apriori",
        "delta_confidence": "delta_conf", "delta_lift": "delta_lift", "winner": "fuente_prioritaria",
        "name_a": "nombre_a", "name_b": "nombre_b", "run_date": "fecha_calculo",
    }),
}


def published_name(table: str) -> str:
    return PUBLISHED[table][0]


def to_published(df: DataFrame, table: str) -> DataFrame:
    """Rename library columns to the published ones; other columns keep their names."""
    names = PUBLISHED[table][1]
    return df.toDF(*[names.get(c, c) for c in df.columns])


def from_published(df: DataFrame, table: str) -> DataFrame:
    """Rename published columns, in any letter case, to the library's."""
    names = {theirs.lower(): ours for ours, theirs in PUBLISHED[table][1].items()}
    return df.toDF(*[names.get(c.lower(), c) for c in df.columns])
