"""Field contracts of the feeds and of the tables built from them.

A contract is written once and used by batch and streaming alike, so the two cannot drift apart.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def contract(fields: str) -> StructType:
    """A schema from ``name type`` pairs; unlike ``StructType.fromDDL`` it needs no running session."""
    schema = StructType()
    for field in fields.replace("\n", " ").split(", "):
        name, kind = field.split()
        schema = schema.add(name, kind)
    return schema


# Field names and types of the main transaction feed (38 fields).
# installments and time_since_last_txn_min arrive as DOUBLE or as INT depending on the producer;
# conform() brings both to the types written here.
TRANSACTION_FIELDS = """
    transaction_id string, customer_id string, session_id string, device_id string, timestamp string,
    type string, amount double, currency string, channel string, ip_address string,
    geolocation_lat double, geolocation_lon double, merchant_id string, merchant_name string,
    merchant_category string, mcc_code string, mcc_risk_level string, card_number_hash string,
    card_brand string, card_type string, installments integer, card_entry string, cvv_validated boolean,
    auth_3ds boolean, pix_key_type string, pix_key_destination string, destination_bank string,
    distance_from_last_txn_km double, time_since_last_txn_min double, transactions_last_24h integer,
    accumulated_amount_24h double, unusual_time boolean, new_beneficiary boolean, status string,
    refusal_reason string, fraud_score double, is_fraud boolean, fraud_type string
"""

# geo/behaviour feed (27 fields); timestamp is an epoch number.
GEO_FIELDS = """
    transaction_id string, customer_id string, amount double, merchant string, category string,
    transaction_hour double, day_of_week string, customer_home_state string, purchase_state string,
    purchase_city string, purchase_latitude double, purchase_longitude double, device_latitude double,
    device_longitude double, device_id string, ip_address string, payment_method string,
    card_brand string, installments integer, had_travel_purchase_last_12m boolean,
    is_first_purchase_in_state boolean, transactions_last_24h double, avg_transaction_amount_30d double,
    is_international boolean, is_online boolean, is_fraud boolean, timestamp long
"""

# Customer dimension as delivered (37 fields, Portuguese names).
CUSTOMER_FIELDS = """
    customer_id string, cpf string, rg string, nome_completo string, nome_social string,
    data_nascimento string, sexo string, estado_civil string, email string, telefone_celular string,
    telefone_fixo string, cep string, logradouro string, numero string, complemento string,
    bairro string, cidade string, estado string, banco_codigo string, banco_nome string,
    agencia string, conta string, tipo_conta string, profissao string, renda_mensal double,
    score_credito integer, limite_credito double, limite_pix_diario double, perfil_investidor string,
    pep boolean, data_cadastro string, status string, nivel_verificacao string, is_premium boolean,
    aceita_marketing boolean, biometria_facial boolean, token_ativo boolean
"""

# Device dimension as delivered (15 fields).
DEVICE_FIELDS = """
    device_id string, customer_id string, device_fingerprint string, manufacturer string, model string,
    os_name string, os_version string, app_version string, screen_resolution string, is_rooted boolean,
    is_emulator boolean, first_seen string, last_seen string, is_trusted boolean, risk_score integer
"""

# Raw message envelope.
ENVELOPE_FIELDS = """
    kafka_key string, raw_json string, topic string, kafka_partition integer, kafka_offset long,
    kafka_timestamp timestamp, ingestion_timestamp timestamp
"""

TRANSACTION = contract(TRANSACTION_FIELDS)
GEO = contract(GEO_FIELDS)
CUSTOMER = contract(CUSTOMER_FIELDS)
DEVICE = contract(DEVICE_FIELDS)
ENVELOPE = contract(ENVELOPE_FIELDS)

# Portuguese feed names and the names used here.
PT_TRANSACTION_NAMES = {
    "tipo": "type", "valor": "amount", "moeda": "currency", "canal": "channel",
    "geolocalizacao_lat": "geolocation_lat", "geolocalizacao_lon": "geolocation_lon",
    "numero_cartao_hash": "card_number_hash", "bandeira": "card_brand", "tipo_cartao": "card_type",
    "parcelas": "installments", "entrada_cartao": "card_entry", "cvv_validado": "cvv_validated",
    "autenticacao_3ds": "auth_3ds", "chave_pix_tipo": "pix_key_type",
    "chave_pix_destino": "pix_key_destination", "banco_destino": "destination_bank",
    "distancia_ultima_transacao_km": "distance_from_last_txn_km",
    "tempo_desde_ultima_transacao_min": "time_since_last_txn_min",
    "transacoes_ultimas_24h": "transactions_last_24h",
    "valor_acumulado_24h": "accumulated_amount_24h", "horario_incomum": "unusual_time",
    "novo_beneficiario": "new_beneficiary", "motivo_recusa": "refusal_reason",
}
PT_STATUS = {"APROVADA": "APPROVED", "RECUSADA": "DECLINED", "BLOQUEADA": "BLOCKED"}
PT_CUSTOMER_NAMES = {
    "cpf": "tax_id", "nome_completo": "full_name", "data_nascimento": "birth_date",
    "estado": "state", "cidade": "city", "cep": "postcode", "telefone_celular": "mobile_phone",
    "telefone_fixo": "home_phone", "renda_mensal": "monthly_income", "score_credito": "credit_score",
    "limite_credito": "credit_limit", "limite_pix_diario": "daily_pix_limit",
    "data_cadastro": "registered_at", "banco_nome": "bank_name",
}

# Columns of the scored Gold table (51 with the write time, which only sinks add).
GOLD_COLUMNS = """
    transaction_id customer_id session_id device_id timestamp_dt tx_date tx_year tx_month tx_hour
    type amount currency channel ip_address geolocation_lat geolocation_lon merchant_id merchant_name
    merchant_category mcc_code mcc_risk_level card_number_hash card_brand card_type installments
    card_entry cvv_validated auth_3ds pix_key_type pix_key_destination destination_bank
    distance_from_last_txn_km time_since_last_txn_min transactions_last_24h accumulated_amount_24h
    unusual_time new_beneficiary status refusal_reason fraud_score fraud_score_category is_fraud
    fraud_type is_high_risk_mcc period_of_day amount_range is_weekend risk_points risk_level
    requires_review
""".split()

# Columns loaded for reporting (30 with the write time).
REPORTING_COLUMNS = """
    transaction_id customer_id timestamp_dt tx_date tx_year tx_month tx_hour type amount currency
    channel merchant_name merchant_category mcc_code mcc_risk_level card_brand card_entry status
    refusal_reason fraud_score fraud_score_category is_fraud fraud_type risk_points risk_level
    requires_review period_of_day amount_range is_weekend
""".split()

# Columns of an alert (24 with the write time).
ALERT_COLUMNS = """
    transaction_id customer_id timestamp_dt type amount merchant_name merchant_category risk_points
    risk_level fraud_score is_fraud fraud_type status distance_from_last_txn_km transactions_last_24h
    accumulated_amount_24h flag_time flag_beneficiary flag_mcc flag_location investigation_status
    analyst_id investigation_notes
""".split()

# Columns of the streaming Silver table (47 with the processing time).
STREAM_SILVER_COLUMNS = """
    transaction_id customer_id session_id device_id event_time transaction_hour type amount_clean
    currency channel ip_address geolocation_lat geolocation_lon merchant_id merchant_name
    merchant_category mcc_code mcc_risk_level card_brand card_type installments card_entry
    cvv_validated auth_3ds pix_key_type destination_bank distance_from_last_txn_km
    time_since_last_txn_min transactions_last_24h accumulated_amount_24h unusual_time new_beneficiary
    is_pix_new_beneficiary is_high_value is_high_velocity is_high_accumulated is_location_jump
    is_manual_card_entry is_no_3ds_online status fraud_score fraud_score_additional
    fraud_score_combined risk_level is_fraud fraud_type
""".split()

# Columns of the streaming alert table (25 with the processing time).
STREAM_ALERT_COLUMNS = """
    transaction_id customer_id device_id event_time type amount_clean channel merchant_name
    merchant_category mcc_risk_level card_brand pix_key_type destination_bank
    distance_from_last_txn_km transactions_last_24h accumulated_amount_24h is_pix_new_beneficiary
    is_location_jump unusual_time fraud_score fraud_score_combined risk_level is_fraud fraud_type
""".split()

# The two tables loaded by the scoring stream (20 and 19 columns), after renaming.
STREAM_LOAD_NAMES = {
    "type": "transaction_type", "amount_clean": "amount", "merchant_name": "merchant",
    "merchant_category": "category", "fraud_score_combined": "fraud_score_total",
}
STREAM_LOAD_COLUMNS = """
    transaction_id customer_id device_id event_time transaction_type amount channel merchant category
    mcc_risk_level card_brand pix_key_type transactions_last_24h accumulated_amount_24h fraud_score
    fraud_score_total risk_level is_fraud fraud_type status
""".split()
STREAM_LOAD_ALERT_COLUMNS = """
    transaction_id customer_id device_id event_time transaction_type amount channel merchant category
    pix_key_type destination_bank is_pix_new_beneficiary is_location_jump distance_from_last_txn_km
    fraud_score fraud_score_total risk_level is_fraud fraud_type
""".split()

# Result tables fed by the live dashboard stream. Rates here are fractions, the batch
# tables hold percentages.
LIVE_METRICS_FIELDS = """
    window_start timestamp, window_end timestamp, total_transactions long, total_amount decimal(18,2),
    fraud_count long, fraud_amount decimal(18,2), fraud_rate decimal(5,4), avg_amount decimal(18,2),
    max_amount decimal(18,2)
"""
LIVE_GROUP_FIELDS = """
    window_start timestamp, window_end timestamp, {key} string, transaction_count long,
    total_amount decimal(18,2), fraud_count long, fraud_rate decimal(5,4)
"""


def pick(df: DataFrame, columns: list[str], schema: StructType = TRANSACTION) -> DataFrame:
    """Select ``columns`` in order; a column the input lacks becomes a null of its contract type."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c) for c in columns]
    )


def conform(df: DataFrame, schema: StructType = TRANSACTION) -> DataFrame:
    """Bring columns whose type drifted to the contract type; values that do not fit become null."""
    have = dict(df.dtypes)
    drifted = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in schema.fields
        if f.name in have and have[f.name] != f.dataType.simpleString()
    }
    return df.withColumns(drifted) if drifted else df


def as_contract(df: DataFrame, fields: str) -> DataFrame:
    """Cast a result to a sink table's column types and order."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in contract(fields).fields])


def schema_gaps(df: DataFrame, schema: StructType) -> list[tuple[str, str, str | None]]:
    """Fields missing from ``df`` or of another type: (name, expected, found)."""
    have = dict(df.dtypes)
    return [
        (f.name, f.dataType.simpleString(), have.get(f.name))
        for f in schema.fields
        if have.get(f.name) != f.dataType.simpleString()
    ]
