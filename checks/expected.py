"""What the checks expect, stated apart from the product: staged columns and indicators.

Fixed values: names, types and texts are those every result must have.
"""

# Select list of each staged table over its raw columns.
STAGED = {
    "comuni": """
        cast(COD_COM as varchar) as cod_com,
        cast(NOM_COM as varchar) as nom_com,
        cast(COD_PROV as varchar) as cod_prov""",
    "province": """
        cast(COD_PROV as varchar) as cod_prov,
        cast(NOM_PROV as varchar) as nom_prov""",
    "rqa_configurazioni": """
        cast(COD_CONF as int) as cod_conf,
        cast(COD_UBIC as varchar) as cod_ubic,
        cast(COD_PARAM as varchar) as cod_param,
        cast(COD_ENTE as varchar) as cod_ente,
        cast(COD_MIS as varchar) as cod_mis,
        cast(COD_FREQ as varchar) as cod_freq,
        cast(STATION_CL_EU as varchar) as station_cl_eu,
        cast(FLG_PUB as varchar) as flg_pub""",
    "rqa_dati_aria_cor": """
        cast(COD_UBIC as varchar) as cod_ubic,
        cast(COD_CONF as int) as cod_conf,
        cast(DATA_DA as timestamp) as data_da,
        cast(DATA_A as timestamp) as data_a,
        cast(VAL_PARAM as double) as val_param,
        cast(case when cast(COD_VALID as int) > 1 then 1 else cast(COD_VALID as int) end as int) as cod_valid,
        cast(COD_VALIDAZ as varchar) as cod_validaz,
        cast(COD_VALIDAZ_REG as varchar) as cod_validaz_reg,
        cast(year(cast(DATA_DA as timestamp)) as int) as anno""",
    "rqa_elementi": """
        cast(COD_ELEMENTO as varchar) as cod_elemento,
        cast(DESCRIZIONE as varchar) as inquinante""",
    "rqa_enti": """
        cast(COD_ENTE as varchar) as cod_ente,
        cast(DESCR_ENTE as varchar) as descr_ente,
        cast(T_RETE as varchar) as t_rete,
        cast(FLAG_PRIVATA as varchar) as flag_privata""",
    "rqa_metodi": """
        cast(COD_METODO as varchar) as cod_metodo,
        cast(DESCRIZIONE as varchar) as metodo""",
    "rqa_parametri": """
        cast(COD_PARAM as varchar) as cod_param,
        cast(DESCR_PARAM as varchar) as descr_param,
        cast(SIGLA_PARAM as varchar) as sigla_param,
        cast(COD_METODO as varchar) as cod_metodo,
        cast(FLAG_PUBBLICO as varchar) as flag_pubblico,
        cast(COD_ELEMENTO as varchar) as cod_elemento""",
    "rqa_t_frequenze": """
        cast(COD_FREQ as varchar) as cod_freq,
        cast(DESCR_FREQ as varchar) as descr_freq""",
    "rqa_t_reti": """
        cast(T_RETE as varchar) as t_rete,
        cast(DESCR_T_RETE as varchar) as descr_t_rete""",
    "rqa_t_stclass_eu": """
        cast(ID as varchar) as station_cl_eu,
        cast(DESC_EU as varchar) as desc_eu""",
    "rqa_t_zona": """
        cast(COD_TZONA as varchar) as cod_tzona,
        cast(TIPO_ZONA as varchar) as tipo_zona""",
    "rqa_ubicazioni": """
        cast(COD_UBIC as varchar) as cod_ubic,
        cast(DESCR_UBIC as varchar) as descr_ubic,
        cast(VIA_UBIC as varchar) as via_ubic,
        cast(COD_PROV as varchar) as cod_prov,
        cast(COD_COM as varchar) as cod_com,
        cast(nullif(CMIRL_LAT, '') as double) as cmirl_lat,
        cast(nullif(CMIRL_LON, '') as double) as cmirl_lon,
        cast(nullif(DATA_DISATTIV, '') as timestamp) as data_disattiv,
        cast(COD_EU as varchar) as cod_eu,
        cast(COD_TZONA as varchar) as cod_tzona""",
    "t_unita_misura": """
        cast(COD_MIS as varchar) as cod_mis,
        cast(SIGLA_MIS as varchar) as sigla_mis""",
    "v_rqa_rete_regionale_ipr": """
        cast(COD_UBIC as varchar) as cod_ubic,
        cast(COD_CONF as int) as cod_conf,
        cast(ANNO as int) as anno""",
}

# Daily ozone: name, reference, condition, note, value, expected, observed.
O3_DAILY = [
    (
        "Ozono (O3): valore massima media oraria",
        "", "", "", "max_val_param", "24", "count_val_param",
    ),
    (
        "Ozono (O3): numero di medie orarie superiori al livello di informazione",
        "soglia informazione: 180 µg/m3", "", "", "count_over_180", "24", "count_val_param",
    ),
    (
        "Ozono (O3): numero di medie orarie superiori al livello di informazione da inizio anno",
        "soglia informazione: 180 µg/m3", "", "", "ytd_over_180", "available_days_ytd * 24", "ytd_count_val",
    ),
    (
        "Ozono (O3): numero di medie orarie superiori al livello di allarme",
        "soglia di allarme: 240 µg/m3", "per 3 ore consecutive", "4 ore consecutive = 2 superi", "count_superi_3h", "24", "count_val_param",
    ),
    (
        "Ozono (O3): numero di medie orarie superiori al livello di allarme da inizio anno",
        "soglia di allarme: 240 µg/m3", "per 3 ore consecutive", "4 ore consecutive = 2 superi", "ytd_superi_3h", "available_days_ytd * 24", "ytd_count_val",
    ),
    (
        "Ozono (O3): valore massima media 8 oraria",
        "", "", "", "max_mv_avg", "24", "count_mv_avg",
    ),
    (
        "Ozono (O3): numero di giorni con medie su 8 ore massime giornaliere superiori al valore obiettivo a lungo termine da inizio anno",
        "obiettivo: 120 µg/m3", "", "", "ytd_8h_over_120", "available_days_ytd", "ytd_valid_days",
    ),
]
# Daily NO2: name, reference, condition, note, value, expected, observed.
NO2_DAILY = [
    (
        "Biossido di azoto (NO2): numero di medie orarie superiori al valore limite orario",
        "200 µg/m3", "", "", "count_over_200", "24", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): numero di medie orarie superiori al valore limite orario da inizio anno",
        "200 µg/m3", "", "", "ytd_over_200", "available_days_ytd * 24", "ytd_count_val",
    ),
    (
        "Biossido di azoto (NO2): valore massimo orario",
        "", "", "", "max_val_param", "24", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): numero di superamenti della soglia di allarme",
        "soglia di allarme: 400 µg/m3", "per 3 ore consecutive", "4 ore consecutive = 2 superi", "count_superi_3h", "24", "count_val_param",
    ),
]
# Daily NO2 mean: name, reference, condition, note, value, expected, observed.
NO2_DAILY_MEAN = [
    (
        "Biossido di azoto (NO2): valore media giornaliera",
        "", "", "", "mean", "24", "n",
    ),
]
# Annual ozone: name, limit, condition, critical level, value, expected, observed.
O3_ANNUAL = [
    (
        "Ozono (O3): numero di giorni con medie su 8 ore massime giornaliere superiori al valore obiettivo a lungo termine",
        "120 µg/m3", "", "", "days_over_120", "available_days_in_year", "valid_days_8h",
    ),
    (
        "Ozono (O3): numero di medie orarie superiori alla soglia di informazione",
        "180 µg/m3", "", "", "count_over_180", "available_hours_in_year", "count_val_param",
    ),
    (
        "Ozono (O3): numero di medie orarie superiori alla soglia di allarme",
        "240 µg/m3", "x 3 ore consecutive", "", "count_superi_3h", "available_hours_in_year", "count_val_param",
    ),
    (
        "Ozono (O3): valore media annuale",
        "", "", "", "mean_val_param", "available_hours_in_year", "count_val_param",
    ),
    (
        "Ozono (O3): 98° percentile",
        "", "", "", "p98_val_param", "available_hours_in_year", "count_val_param",
    ),
    (
        "Ozono (O3): deviazione standard",
        "", "", "", "stddev_val_param", "available_hours_in_year", "count_val_param",
    ),
    (
        "Ozono (O3): mediana",
        "", "", "", "median_val_param", "available_hours_in_year", "count_val_param",
    ),
]
# Annual NO2: name, limit, condition, critical level, value, expected, observed.
NO2_ANNUAL = [
    (
        "Biossido di azoto (NO2): numero di medie orarie superiori al limite",
        "200 µg/m3", "max 18/anno", "", "count_over_200", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): numero di medie orarie superiori alla soglia UAT",
        "140 µg/m3", "max 18/anno", "", "count_over_140", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): numero di medie orarie superiori alla soglia LAT",
        "100 µg/m3", "max 18/anno", "", "count_over_100", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): valore massima media oraria",
        "", "", "", "max_val_param", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): numero di superamenti della soglia di allarme",
        "400 µg/m3", "x3 ore consecutive", "", "count_superi_3h", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): valore media annuale",
        "", "", "livello critico: 40 µg/m3, UAT: 32 µg/m3, LAT: 26 µg/m3", "mean_val_param", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): 98° percentile",
        "", "", "", "p98_val_param", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): deviazione standard",
        "", "", "", "stddev_val_param", "available_hours_in_year", "count_val_param",
    ),
    (
        "Biossido di azoto (NO2): mediana",
        "", "", "", "median_val_param", "available_hours_in_year", "count_val_param",
    ),
]
# Annual NOX: name, limit, condition, critical level, value, expected, observed.
NOX_ANNUAL = [
    (
        "Ossidi di azoto (NOx): valore media annuale",
        "", "", "livello critico: 30 µg/m3 NO2, UAT: 24 µg/m3 NO2, LAT: 19.5 µg/m3 NO2", "mean_val_param", "available_hours_in_year", "count_val_param",
    ),
]
