"""Default taxonomy of job titles and companies."""

from __future__ import annotations

# Job-title patterns, tried in this order. Each alternative must
# stand between word boundaries, except those listed as free.
POSITION_WORDS = [
    ("Etudiant", [
        "étudiant", "etudiant", "student", "élève", "eleve", r"master\s+\d", "bachelor",
        r"école\s+d", r"ecole\s+d",
    ]),
    ("Stagiaire", ["stagiaire", "intern(?:ship)?", "trainee", "stage"]),
    ("Alternant", [
        "alternant", "alternance", "apprenti", "apprentice", r"work[\s\-]study", r"contrat\s+pro",
    ]),
    ("Directeur", [
        "directeur", "directrice", "director", r"head\s+of", "chief", "cto", "cfo", "ceo", "coo",
        "cso", "président", "president", "fondateur", "founder", r"managing\s+partner",
        r"associé\s+gérant", "professor", "professeur", r"maître\s+de\s+conf", "enseignant",
        r"chargé\s+de\s+cours", r"domain\s+lead", r"people\s+lead", r"vice[\s\-]?president", "vp",
    ]),
    ("Manager", [
        "manager", "managing", "responsable", "teamlead", r"team\s+lead", "lead", "senior",
        "sénior", "expert", "supervise", "superviseur", r"managing\s+partner", "partner", "gérant",
    ]),
]
POSITION_FREE = {"Stagiaire": ["inter?n?ship"]}
POSITION_DEFAULT = "Junior"

# Known company names in lower case, categories in order of priority.
KNOWN_COMPANIES = [
    ("Assurance", [
        "société générale assurances", "bpce assurances", "axa", "axa en france", "axa belgium",
        "allianz", "allianz france", "allianz benelux", "allianz côte d'ivoire",
        "sanlamallianz côte d'ivoire", "maif", "ethias", "federale assurance-verzekering",
        "federale assurance", "belfius insurance", "crédit agricole assurances",
        "credit agricole assurances", "bnp paribas cardif", "groupe bpce",
        "kbc bank & verzekering", "kbc", "suravenir", "prévoir", "prevoir", "dkv belgium",
        "europ assistance", "ag insurance", "lourmel", "assurance d'assistance",
        "contassur - cac/cba", "contassur", "leadway assurance côte d'ivoire",
        "crecer seguros - compañía de seguros", "crecer seguros",
    ]),
    ("Réassurance", ["scor", "qbe re", "arch reinsurance (europe)", "arch reinsurance"]),
    ("Courtier", ["aon", "aon luxembourg", "wtw", "willis towers watson", "marsh", "gallagher"]),
    ("Cabinet de conseil", [
        "detralytics", "oliver wyman", "deloitte", "nexialog consulting", "nexialog", "prim'act",
        "addactis", "triple a - risk finance belgium", "triple a risk finance",
        "owl mind analytics", "statismatic lab", "meinay", "actualib'", "actualib", "nexyan",
        "fgas", "actu-alia",
    ]),
    ("Scolaire", [
        "université de strasbourg", "université libre de bruxelles", "ulb",
        "ichec brussels management school", "ichec", "collège catholique anuarite",
        "cameroun, ministère de l'enseignement secondaire",
        "ministère de l'enseignement secondaire",
        "banque nationale de belgique (bnb) / national bank of belgium",
        "banque nationale de belgique", "national bank of belgium", "spuerkeess",
    ]),
]

# Company patterns, tried in this order.
COMPANY_WORDS = [
    ("Scolaire", [
        "université", "universite", "university", "école", "ecole", "school", "collège",
        "college", "institut", "institute", "académie", "academie", "academy", "lycée", "lycee",
        "enseignement", "éducation", "education", "faculty", "faculté", "faculte", "campus",
    ]),
    ("Réassurance", ["réassurance", "reassurance", "reinsurance", r"ré\s*assurance", "re"]),
    ("Courtier", [
        "courtier", "courtage", "broker", "brokerage", "aon", "wtw", "willis", "marsh",
        "gallagher", "howden",
    ]),
    ("Cabinet de conseil", [
        "conseil", "consulting", "consultancy", "consultant", "advisory", "advisors",
        "actuariel", "actuarial", "cabinet", "analytics", "lab", "solutions",
    ]),
    ("Assurance", [
        "assurance", "assurances", "insurance", "verzekering", "seguros", "assicurazione",
        "mutuelle", "prévoyance", "prevoyance", "garantie", "protection", "assistance",
    ]),
]
COMPANY_DEFAULT = "Autre"
