"""Fixed values of the business rules: code lists, labels and mappings."""

from __future__ import annotations

# Plants (name -> code).
PLANTS = {"sob": 20, "for": 21, "cra": 40}

# Sectors and factories left out of the OEE.
EXCLUDED_SECTORS = (52, 69, 74, 59, 50, 36, 70, 66, 62)
# The detail queries keep sector 62.
EXCLUDED_SECTORS_DETAIL = (52, 69, 74, 59, 50, 36, 70, 66)
EXCLUDED_FACTORIES = (38, 43)

WEIGHTED = "Com Peso"
UNWEIGHTED = "Sem Peso"
SETUP = "Setup"
YES = "Sim"
NO = "Não"

# Third shift start that always belongs to the next day (00:57:01).
NEXT_DAY_SHIFT3_START = 3421

# Stop family id -> family group.
FAMILY_GROUP = {
    65: 2, 66: 3, 67: 1, 70: 1, 71: 4, 73: 1, 76: 1, 78: 1, 79: 1, 80: 1, 81: 1, 82: 1,
    83: 1, 84: 1, 86: 5, 87: 1, 115: 3, 116: 2, 119: 1, 120: 1, 121: 1, 122: 1, 137: 1,
    138: 1, 139: 2,
}
FAMILY_GROUP_NAME = {
    1: "Produção",
    2: "Manutenção",
    3: "Matrizaria",
    4: "Tingimento",
    5: "Setup",
}

# Setup type by plant and stop reason, for stops whose group carries no setup type.
SETUP_TYPE = {
    20: {
        100: "Setup de Cor",
        107: "Setup de Matriz",
        125: "Troca de Layout",
        126: "Troca de Numeração",
        149: "Troca de Produto",
        400: "Setup de Matriz",
        402: "Troca de Coleção",
        816: "Deslocamento de Equipe",
        826: "Ligada de Máquina",
        892: "Setup de Cor - Limpeza de Bico",
        1701: "Setup de Cor - Glitter",
        1728: "Setup de Matriz e Cor",
    },
    21: {
        100: "Setup de Cor",
        107: "Setup de Matriz",
        125: "Troca de Layout",
        126: "Troca de Numeração",
        149: "Troca de Produto",
        184: "Setup de Cor - Glitter",
        422: "Deslocamento de Equipe",
    },
    40: {
        100: "Setup de Cor",
        107: "Setup de Matriz",
        125: "Troca de Layout",
        126: "Troca de Numeração",
        149: "Troca de Produto",
        150: "Troca de Grade",
        402: "Troca de Coleção",
        422: "Deslocamento de Equipe",
    },
}

# Setup label of an ungrouped stop in the stop detail.
UNGROUPED_SETUP_LABEL = {
    100: "Troca de Cor",
    107: "Setup Matriz",
    125: "Troca de Layout",
    126: "Troca Numeração",
    149: "Troca de Produto",
    400: "Setup Matriz",
    402: "Troca de coleção",
    816: "Deslocamento de Equipe",
    826: "Ligada de Máquina",
    892: "Troca de Cor com Limpeza de Bico",
    1701: "Troca de Cor com Glitter",
    1728: "Setup de Matriz e Cor",
}
# These two codes count as setup only outside the listed factories.
FACTORY_BOUND_SETUP_CODES = (816, 826)
FACTORIES_WITHOUT_BOUND_SETUP = (28, 31, 32)

# The first stop of a group names its setup unless it has one of these codes.
NOT_A_GROUP_SETUP = (0, 106, 1614)

# "Flat" reasons: code set per setup label, and codes that are always flat.
FLAT_REASONS = {
    "Setup Matriz": (107, 454, 1704, 400, 1041, 129),
    "Troca de Cor": (100, 1707, 1708, 129),
}
ALWAYS_FLAT_REASONS = (892, 1701)

OPEN_STATUSES = (1, 4)

# Per-machine cycle tables: name pattern, and names that match but hold no machine.
CYCLE_TABLE_PATTERN = r"^Ciclo (\d+)$"
CYCLE_TABLE_EXCLUDED = ("Ciclo 0", "Ciclo_Plastisol")

# Month -> bimester label.
BIMESTER = {
    1: "jan-fev", 2: "jan-fev", 3: "mar-abr", 4: "mar-abr", 5: "mai-jun", 6: "mai-jun",
    7: "jul-ago", 8: "jul-ago", 9: "set-out", 10: "set-out", 11: "nov-dez", 12: "nov-dez",
}

# Improvement type -> category.
IMPROVEMENT_CATEGORY = {
    "Tempo Ciclo": "Tempo Ciclo",
    "Aglutinação": "Tempo Ciclo",
    "Consumo": "Consumo",
    "Troca de Matéria Prima": "Troca de Matéria Prima",
    "Logística interna e Outros": "Outros",
    "Acondicionamento": "Outros",
    "Administrativas": "Outros",
    "Manutenção": "Outros",
    "FAO": "Outros",
    "Eficiência energética": "Outros",
    "Qualidade": "Outros",
    "Gestão de resíduos": "Outros",
    "Matrizaria": "Outros",
    "T.I.": "Outros",
    "Logística interna": "Outros",
    "RH": "Outros",
    "Saúde e Segurança": "Outros",
    "Ergonomia": "Outros",
    "GGF": "Outros",
    "Logística externa": "Outros",
    "Gestão hídrica": "Outros",
    "MOI/MOA": "Outros",
}
CYCLE_TIME_TYPES = ("Tempo Ciclo", "Aglutinação")
CONSUMPTION_TYPE = "Consumo"
MATERIAL_SWAP_TYPE = "Troca de Matéria Prima"
MATERIAL_SWAP_SECTOR_PREFIX = "Ting"

# Manager remap: name -> (new name, first period start the rule no longer applies to).
MANAGER_REMAP = (
    ("Andre Miorelli", "Andre - F4", None),
    ("Beatriz", "Valsenir F6", "2025-05-01"),
    ("Beatriz F5", "Ademir Tênis", "2025-05-01"),
    ("Liberio", "Andre - F3", "2023-05-01"),
    ("Douglas Monteiro", "Andre - F4", None),
    ("Ademir", "Ademir - F1", None),
    ("Odair", "Ademir - F5", None),
    ("Ademar", "Tiago", None),
    ("Adair", "Liberio", None),
    ("Andre Luis", "Ana Livia", None),
    ("E-Commerce", "Martinho", None),
    ("Gerência PPCP", "Martinho", None),
)

APPROVED = "Aprovado"
IN_PROGRESS = "Em andamento"
REJECTED = "Reprovado"
PENDING_MASTER_DATE = "Pendente data da fap"
NOT_ELIGIBLE = "Não Elegível"
COUNTS = "Considera"
FAILED_STATUSES = ("Falha no fluxo", "Reprovado", "Tempo de aprovação expirado")
MANAGERS_OUTSIDE_TARGET = ("Sul", "Rossi")
ENGINEERING_COST_CENTRES = ("2048", "2049", "2148", "2149", "4048", "4049")

# Workflow logs that feed the tooling tables.
TOOLING_WORKFLOWS = (
    "8b301608-9bc5-4042-9835-7e02d4beec52",
    "395ecda5-ab4f-442f-8115-196752a8a33e",
)
WEBHOOK_NODE_PATTERN = r'getWorkflowVariable\("([a-f0-9\-]+)\.numeroProcesso"\)'

# List dates: local zone, anchor tolerance (days), empty tokens.
LOCAL_ZONE = "America/Fortaleza"
ANCHOR_TOLERANCE_DAYS = 2
EMPTY_DATE_TOKENS = ("", "nan", "none", "nat", "null")
# First three letters of month names, English and then Portuguese.
MONTH_NAMES = (
    "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
    "jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez",
)
# Years of two digits below it are of this century.
TWO_DIGIT_YEAR_PIVOT = 69
