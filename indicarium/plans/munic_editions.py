"""How the editions of the municipal survey name their external variables, year by year.

The names are those of the survey's own files; editions that are not listed use
the common names already.
"""

from __future__ import annotations

# fixed values: edition -> (column of that edition's file -> common name)
RENAMES = {
    2021: {"Pop estimada 2021": "Populacao"},
    2019: {"REGIAO": "Regiao", "COD UF": "Cod UF", "NOME MUNIC": "Mun", "POP EST": "Populacao", "CLASSE POP": "Faixa_pop"},
    2018: {"REGIAO": "Regiao", "COD UF": "Cod UF", "NOME MUNIC": "Mun", "POP EST": "Populacao", "CLASSE POP": "Faixa_pop"},
    2017: {"REGIAO": "Regiao", "COD UF": "Cod UF", "NOME MUNIC": "Mun", "POP EST": "Populacao", "CLASSE POP": "Faixa_pop"},
    2015: {"A199": "Regiao", "A200": "Cod UF", "A201": "UF", "A202": "Mun", "A204": "Populacao", "A203": "Faixa_pop"},
    2014: {"A1024": "Regiao", "A1022": "Cod UF", "A1026": "UF", "A1027": "Mun", "A1028": "Populacao", "A1029": "Faixa_pop"},
    2013: {"A393": "Regiao", "A391": "Cod UF", "A1026": "UF", "A394": "Mun", "A395": "Populacao", "A396": "Faixa_pop"},
    2012: {"A534": "Regiao", "A535": "Cod UF", "A536": "UF", "A537": "Mun", "A539": "Populacao", "A538": "Faixa_pop"},
    2011: {"A567": "Regiao", "A568": "Cod UF", "A569": "UF", "A570": "Mun", "A572": "Populacao", "A571": "Faixa_pop"},
    2009: {"A737": "Regiao", "A738": "Cod UF", "A739": "UF", "A741": "Mun", "A740": "Faixa_pop"},
    2008: {"A335": "Regiao", "A336": "Cod UF", "A337": "UF", "A338": "Mun", "A339": "Populacao", "A340": "Faixa_pop"},
    2006: {"A355": "Regiao", "A356": "Cod UF", "A357": "Mun", "A358": "Populacao", "A359": "Faixa_pop"},
    2005: {"A324": "Regiao", "A325": "Cod UF", "A326": "Mun", "A327": "Populacao", "A328": "Faixa_pop"},
    2004: {"A158": "Regiao", "A159": "UF", "A164": "Mun", "A161": "Populacao", "A162": "Faixa_pop"},
}

# fixed values: columns of an edition's file that are left out
DROPS = {2014: ["A1023", "A1025"], 2013: ["A392"], 2005: ["A329"], 2004: ["A160", "A163"]}

EDITIONS = [2021, 2020, 2019, 2018, 2017, 2015, 2014, 2013, 2012, 2011, 2009, 2008, 2006, 2005, 2004, 2002, 2001]
COMMON = ["Regiao", "Cod UF", "UF", "Mun", "Populacao", "Faixa_pop"]

#: (edition, column, common name) and (edition, column), as ``harmonise_by_table`` takes them.
RENAME_ROWS = [(e, source, target) for e, names in RENAMES.items() for source, target in names.items()]
DROP_ROWS = [(e, c) for e, names in DROPS.items() for c in names]
