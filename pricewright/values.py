"""Fixed business values: the word lists, codes and account stacks the results depend on."""

from __future__ import annotations

# --- Fixed values: sales organisations -------------------------------------------------
SALES_ORGS = ["BRIN", "BRIO", "BRDI", "BRDO", "BRCC", "BRCO", "BRCG", "BRGO"]
SALES_ORGS_WITH_TRADING = SALES_ORGS + ["BRTR", "BRTO"]
SALES_ORGS_WITH_EXPORT = SALES_ORGS + ["BREX", "BREZ", "BREO"]

# Organisations merged into their main code.
SALES_ORG_MERGE = {"BRCO": "BRCC", "BRGO": "BRCG", "BRIO": "BRIN", "BRDO": "BRDI"}

DISTRIBUTION_ORG = "BRCG"  # the organisation whose prices carry condition BX41
RESALE_ORG = "BRDI"  # the organisation priced by order date, and the mark-up base

# --- Fixed values: document types --------------------------------------------------------
BILLING_TYPES = ["ZF2B"]

ORDER_TYPES = [
    "YORB", "ZORB", "ZVOI", "YVOI", "ZCNC", "ZVOD", "YCNC", "ZNFC", "ZNNC", "ZNNL",
    "ZRNP", "ZRLC", "ZDNC", "ZDNM", "ZNFD", "B4", "B3", "ZCUP", "#", "YVOD",
]

# --- Fixed values: labels -----------------------------------------------------------------
UNKNOWN_BRANCH = "Filial Não Encontrada"
UNKNOWN_SELLER = "Vendedor Não Identificado"
UNKNOWN_GROUP = "NÃO INFORMADO"
NO_PRICE = "Sem Preço"
GENERIC_CUSTOMER_GROUP = "GRUPO DE RENTABILIDADE GENÉRICO"
YES, NO = "Sim", "Não"

# Sales organisation text -> sale channel, first match wins.
CHANNEL_BY_ORG = [("CC", "Usina-Mercado"), ("CG", "Distribuição-Mercado")]
CHANNEL_OTHER = "Usina-Distribuição"

# Sale channel -> report label.
CHANNEL_LABELS = {
    "Usina-Mercado": "Sell-in 1: Usina-Construtora/Industria",
    "Usina-Distribuição": "Sell-in 1: Usina-Distribuição",
    "Distribuição-Mercado": "Sell-in 2: Distribuição-Revenda",
}
CHANNEL_LABEL_OTHER = "Sell Out: Revenda-Consumidor"

# Run-rate buckets.
STATUS_LOW, STATUS_MID, STATUS_HIGH = "Abaixo 80%", "Entre 80% e 100%", "Acima ou igual a 100%"

# --- Fixed values: letters folded to their base letter, characters dropped from join keys ---
ACCENTED = "ÁÃÀÂÄÉÈÊËÍÌÎÏÓÕÒÔÖÚÙÛÜÇ"
UNACCENTED = "AAAAAEEEEIIIIOOOOOUUUUC"
KEY_DROPPED = "`'-/ "

# --- Fixed values: unit label contained in the survey text -> unit factor column. Longer
# labels stand before the shorter ones they contain. -----------------------------------------
SURVEY_UNITS = [
    ("BARRA", "ZBA"), ("ROLO", "ROL"), ("PEÇA", "ST"), ("TONELADA", "TO"), ("CAIXA", "KI"),
    ("FEIXE", "ZFX"), ("METRO2", "M2"), ("METRO", "M"), ("CENTO", "ZCT"), ("UNIDADE", "ZUN"),
]
CRM_UNITS = [
    ("BR", "ZBA"), ("RL", "ROL"), ("PC", "ST"), ("CENTO", "ZCT"), ("ROLO", "ROL"),
    ("CAIXA", "KI"), ("CX", "KI"), ("FEIXE", "ZFX"), ("METRO2", "M2"), ("METRO", "M"),
    ("PN", "ST"), ("UNIDADE", "ZUN"), ("T", "TO"),
]
UNIT_CODES = ["KG", "KI", "M", "M2", "ROL", "ST", "TO", "ZBA", "ZCT", "ZFX", "ZUN"]

# --- Fixed values: partner role code -> column of the client dimension ------------------------
PARTNER_ROLES = {
    "AG": "ORDER_ISSUER",
    "RE": "INVOICE_RECEIVER",
    "RG": "PAYER",
    "WE": "MERCHANT_RECEIVER",
    "YR": "BR_REGIONAL",
    "Z1": "SALES_MANAGER",
    "Z2": "SALES_REPRESENTATIVE_COMMISSION",
    "Z3": "TECHNICAL_ASSISTENT",
    "Z6": "PROFITABILITY_GROUP",
    "ZG": "SALES_DIRECTOR",
    "ZO": "EXTERNAL_SALESMAN",
}

# --- Fixed values: product hierarchy code lengths ---------------------------------------------
HIERARCHY_LENGTHS = [1, 3, 5, 8, 11, 14, 18]

# --- Fixed values: account stacks, "+account -account" ------------------------------------------
PROFIT_STACKS = {
    "CUSTO_OPERACIONAL": (
        "+gtk101088 +gtk101092 +gtk101093 +gtk101094 +gtk101095 +gtk101096 +gtk101229 +gtk101226 "
        "+gtk101222 +gtk101228 +gtk101221 +gtk101225 +gtk101224 +gtk101223 +gtk101227 +gtk101231 "
        "+gtk103150 +gtk101091"
    ),
    "COGS_ADJUSTMENTS": "-gtk101107 -gtk101110 -gtk101115 -gtk101108 -gtk101109",
    "PORT_EXPENSES": "+gtk101087",
    "SHIP_DEL_LOAD_C_C": "-gtk101112 -gtk101114",
    "FREIGHT": "-gtk101090 +gtk101086 -gtk101127 +gtk101233 +gtk102651 -gtk102652",
    "GTPM056": "-gtk103150",
    "COGS_TOTAL": (
        "-gtk101088 -gtk101091 -gtk101092 -gtk101093 -gtk101094 -gtk101095 -gtk101096 -gtk101103 "
        "-gtk101226 -gtk101097 -gtk101229 -gtk101098 -gtk101221 -gtk101099 -gtk101222 -gtk101100 "
        "-gtk101223 -gtk101101 -gtk101224 -gtk101102 -gtk101225 -gtk101104 -gtk101105 -gtk101227 "
        "-gtk101106 -gtk101228 -gtk101231"
    ),
    "GROSS_SALES": "+gtk101085 +gtk101126 +gtk101238 +gtk101236 +gtk103147 +gtk103148 +gtk103149",
    "SALES_TAX_DISCOUNT": (
        "-gtk101113 -gtk101116 +gtk101117 +gtk101118 +gtk101119 +gtk101120 +gtk101121 +gtk101122 "
        "+gtk101123 -gtk101124"
    ),
    "COMISSION_TO_AGENTS": "+gtk101125",
}
PROFIT_QUANTITY = "gtk101129"

# --- Fixed values: product groups in scope -------------------------------------------------------
PRODUCT_GROUPS = """
BR-PERFIS ESTRUTURAIS
BR-CA50
BR-CA60
BR-RECOZIDO
BR-TEL TUBO
BR-TELA P/ CONCRETO
BR-CORTE E DOBR
BR-CONSTRUCAO CIVIL
BR-CA25
BR-PERFIS COMERCIAIS
BR-BTG
BR-MALHA POP
BR-TELA COLUNA
BR-TRELIÇA
BR-B.TREFILADA
BR-OVALADO
BR-GALVANIZADO
BR-BARRAS COMERCIAIS
BR-CAIXOTARIA
BR-ARTEFATOS
BR-FARPADO
BR-ELETRODO
BR-SOLDA - MIG
BR-CANTON A572
BR-GGS
BR-ARMADO
BR-CORDOALHA
BR-ESTACA PRANCHA
BR-ARAME PREGO
BR-CABEÇA DUPLA
BR-CORDOALHA AGRO
BR-GRAMPO
BR-COBREADOS
BR-CHAPA LQ
BR-UDC
BR-CHAPA ZN
BR-TELHA AZ
BR-TUBO ZN
BR-MARCENARIA
BR-PREGOES
BR-TELHEIRO
BR-COLUNA
BR-ESTRIBO
BR-ACESSORIOS
BR-CHAPA LCG
BR-CHAPA LF
BR-TUBO LF
BR-CHAPA LQ PISO
BR-BOBININHA
BR-ESPECIAIS
BR-BOBINA LQ
BR-FITA LQ
BR-BOBINA AZ
BR-AÇOS ESPECIAIS
BR-PARAFUSOS
BR-CIMENTO
BR-TUBO LQ
BR-TELHA ZN
BR-BTC GLV CP
BR-BOBINA ZN
BR-S-BARRA LAMINADA MÉDIA
BR-S-BARRA LAMINADA PESADA
BR-FITA LF
BR-FITA AZ
BR-S-BARRA LAMINADA LEVE
BR-ALAMBRADO
BR-SAPATA
BR-MOURÃO
BR-ATC CLARO IND
BR-POLIDO
BR-PERFIL BENEFICIADO
BR-BOBINA LF
BR-S-BARRA CTT
BR-CHAPA AZ
BR-FITA ZN
BR-LDA
BR-PIATINA CLARA
BR-S-BARRA DESCASCADA
BR-MESH
BR-S-BARRA FORJADA FINA
BR-S-BARRA RETIFICADA
BR-S-BARRA TREFILADA
BR-PLACA
BR-COIL
BR-S-FERRAMENTA
BR-S-FIO MÁQUINA STT
BR-ATC CLARO MOL COL
BR-ATC GLV CP
BR-B.CHATA LONGARINA
BR-BT FORJARIA BLOCOS
BR-TARUGO
BR-DRAWING
BR-ATC CLARO ENF ALG
BR-PIATINA GLV
BR-PERFIL DORMENTE
BR-ATC
BR-CHQ
BR-ALMA DE ELETRODO
BR-FIO MAQUINA
BR-CHQ BORO
BR-PERFIL GUIA ELEV
""".strip().splitlines()

# --- Fixed values: marketing groups in scope ------------------------------------------------------
MARKETING_GROUPS = [
    "PERFIS_ESTRUTURAIS", "VERGALHAO", "AMPLIADOS", "CORTE_DOBRA", "PREGOS", "B&P", "ARAMES_AGRO",
    "ARAMES_IND", "PLANOS_LQ", "PLANOS_REVESTIDOS", "PLANOS_LF", "PLANOS_LCG", "FIO_MAQUINA",
    "BT_FORJARIA", "PLACAS", "TARUGO",
]
