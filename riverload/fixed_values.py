"""Fixed values of the water-monitoring domain.

Codes, labels and category names below are data: results only agree with other
producers of the same tables when they are kept exactly as written.
"""

# --- Fixed values: site types (last three characters of a site id) ---
TYPE_DISCHARGE = "026"
TYPE_PLANT = "029"
TYPE_INDUSTRY = "012"
TYPE_SEWER_NETWORK = "243"
TYPE_FARM = "013"
TYPE_SEWER_POINT = "242"

# Origins that end the upstream walk.
STOP_TYPES = ("029", "012", "243", "013")

# Link families "upstream type-downstream type" of industrial self-monitoring.
INDUSTRY_TO_POINT = ("085-224", "025-224")
INDUSTRY_TO_DISCHARGE = ("085-026", "025-026")

# Locations of plant monitoring points that can sit on a discharge.
PLANT_DISCHARGE_LOCATIONS = ("A2", "A5", "A4")

# Discharge class by origin type; anything else is DISCHARGE_CLASS_OTHER.
DISCHARGE_CLASSES = {"029": "STEU", "243": "SCL", "012": "INDUSTRIE"}
DISCHARGE_CLASS_OTHER = "AUTRE"

TO_CHECK = "oui"

# --- Fixed values: measurements ---
KIND_PLANT = "STEP"
KIND_NETWORK = "SCL"
PARAM_FLOW = "1552"
PARAM_VOLUME = "1098"
UNIT_FLOW = "120"
VOLUME_POINTS = ("A1", "R1", "A2", "A3", "A4", "A5", "A7")
DISCHARGE_POINTS = ("A1", "R1", "A2", "A4", "A5")
RATIO_POINT = "A4"
POLLUTANTS = ("1313", "1314", "1305", "1319", "1335", "1339", "1340", "1551", "1350")
REMARK_NOT_DONE = "0"

LABEL_MEASURED_PLANT = "Flux jour Bilan 24h"
LABEL_MEASURED_NETWORK = "Flux jour déversement"
LABEL_ZERO_FLOW = "Flux réel nul (débit nul)"
LABEL_ESTIMATED = "Flux estimé reconstitué"
LABEL_TO_ESTIMATE = "Débit non nul - Flux à estimer avec A3 step"

# --- Fixed values: size classes of sewer networks, smallest first ---
SIZE_CLASSES = {
    "< 120 kgDBO/j": "<120",
    "de 120 à 600 kgDBO/j": "120-600",
    "> 600 kgDBO/j": ">600",
}

# --- Fixed values: territorial offices and their managing units ---
OFFICE_MANAGERS = {
    "DBN": ("Pollution Bocages Normands",),
    "DSAV": ("Pollution Seine Aval",),
    "DVO": ("Pollution Vallées d'Oise",),
    "DVM": ("Pollution Vallées de Marne",),
    "DSAM": ("Pollution Seine Amont",),
    "DSF": ("Pollution Ile de France", "Pollution Petite Couronne"),
}
OFFICE_EXTRACTS = {"DSF": ("DSF_DRIF", "DSF_DPPC")}
SITUATION_CLOSED = "CL"

# --- Fixed values: perimeter layers and run parameters ---
LAYER_OFFICE = "DT"
LAYER_CUSTOM = "PERSONNALISE"
LAYERS = ("DT", "DEPARTEMENT", "UH", "EPCI", "PERSONNALISE")
RUN_PARAMETERS = ("TYPE_PERIMETRE", "PERIMETRE", "DT", "TAMPON", "perimetre_custom")

# --- Fixed values: source header -> working name ---
MEASURE_NAMES = {
    "Code analyse": "id_analyse",
    "DT": "DT",
    "Code SANDRE": "Code_SANDRE",
    "PP_No interne Sitou": "PP_No_interne_Sitou",
    "Pt SANDRE": "Pt_SANDRE",
    "Date début prélèvt": "Date_debut_prel",
    "Date du dépôt": "Date_depot",
    "Code sandre paramètre": "Code_sandre_parametre",
    "Code unité": "Code_unite",
    "Val résultat analyse": "Val_resultat_analyse",
    "Dernière qualification analyse": "Derniere_qualif_analyse",
    "Code remarque": "Code_remarque",
    "Commentaire analyse": "Commentaire_analyse",
}
SEWER_POINT_NAMES = {
    "DT": "DT",
    "Code_SANDRE_SCL": "Code_SANDRE_SCL",
    "Nom_SCL": "Nom_SCL",
    "No interne Sitou": "PP_No_interne_Sitou",
    "Nom Sitou": "NOM",
    "Identifiant principal Sitou": "PP_Identifiant_principal_Sitou",
    "LocalisationSitouref": "Pt_SANDRE",
    "Classe": "Classe",
    "Type réseau": "Type_reseau",
}
PLANT_LIST_NAMES = {
    "VALEUR_FCT_PRINCIPAL": "Code_SANDRE",
    "NOM": "NOM",
    "MOA (Roseau)": "MO_ROSEAU",
    "IDTYPE_SITUATION": "Situation",
    "29.CAPACIT - Capacité nominale": "capacite",
}
SITE_XY_NAMES = {
    "No interne Sitou": "identifiant",
    "Nom Sitou": "Nom_Sitou",
    "Coordonnée X L93": "X",
    "Coordonnée Y L93": "Y",
}

# Key of one analysis result; the newest deposit of a key wins.
RESULT_KEYS = (
    "DT", "Code_SANDRE", "Pt_SANDRE", "Code_sandre_parametre",
    "PP_No_interne_Sitou", "Date_debut_prel",
)

# Attributes of the measured structure, carried from the measures to the annual tables.
PLANT_ATTRIBUTES = ("Station_Nom_Sitou", "Step_Capacite_nominale")
NETWORK_ATTRIBUTES = ("SCL_Nom_Sitou", "Classe_CBPO", "Identifiant_pt_AS", "Nom_pt_AS")
