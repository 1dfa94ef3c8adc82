"""English labels of the stored Portuguese values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. A trailing "%" marks a prefix; the first match wins.
MODALITY_LABELS = [
    ("Financiamentos rurais%", "Rural and agribusiness financing"),
    ("Outros créditos", "Other credit"),
    ("Empréstimos", "Loans"),
    ("Financiamentos", "Financing"),
    ("Financiamentos imobiliários", "Real estate financing"),
    ("Direitos creditórios descontados", "Discounted receivables"),
    ("Adiantamentos a depositantes", "Advances to depositors"),
    ("Financiamentos à exporta%", "Export financing"),
    ("Financiamentos à importa%", "Import financing"),
    ("Financiamentos com interveniência", "Financing with intervening party"),
    (
        "Financiamentos de infraestrutura e desenvolvimento",
        "Infrastructure and development financing",
    ),
    ("Financiamentos de títulos e valores mobiliários", "Securities financing"),
    ("Operações de arrendamento", "Leasing"),
    ("Outros", "Others"),
]
CLIENT_TYPE_LABELS = [("PF", "Individuals"), ("PJ", "Businesses")]
CLIENT_SIZE_LABELS = [
    ("Sem rendimento", "No income"),
    ("Indisponível", "Not available"),
    ("Até 1 salário mínimo", "Up to 1 min. wage"),
    ("Mais de 1 a 2%", "1–2 min. wages"),
    ("Mais de 2 a 3%", "2–3 min. wages"),
    ("Mais de 3 a 5%", "3–5 min. wages"),
    ("Mais de 5 a 10%", "5–10 min. wages"),
    ("Mais de 10 a 20%", "10–20 min. wages"),
    ("Acima de 20%", "Over 20 min. wages"),
    ("Micro", "Micro"),
    ("Pequeno", "Small"),
    ("Médio", "Medium"),
    ("Grande", "Large"),
]
BAND_LABELS = [("Alto", "High"), ("Médio", "Medium"), ("Baixo", "Low")]
BANDS = [english for _, english in BAND_LABELS]


def translate_label(value: Column, labels: list[tuple[str, str]]) -> Column:
    """First matching label; a value without one passes through."""
    matches = [
        F.when(
            value.startswith(source[:-1]) if source.endswith("%") else value == source, F.lit(label)
        )
        for source, label in labels
    ]
    return F.coalesce(*matches, value)
