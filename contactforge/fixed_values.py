"""Published constants and agreed names that results depend on.

Nothing here is logic. Scales and pK values come from the public literature named beside them.
"""

# --- alphabets -----------------------------------------------------------------------------
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"

THREE_TO_ONE = {
    "ALA": "A", "CYS": "C", "ASP": "D", "GLU": "E", "PHE": "F", "GLY": "G", "HIS": "H",
    "ILE": "I", "LYS": "K", "LEU": "L", "MET": "M", "ASN": "N", "PRO": "P", "GLN": "Q",
    "ARG": "R", "SER": "S", "THR": "T", "VAL": "V", "TRP": "W", "TYR": "Y",
    "ASX": "B", "GLX": "Z", "XAA": "X", "XLE": "J", "SEC": "U", "PYL": "O",
}

# --- residue composition without the terminal water: residue -> (C, H, N, O, S) --------------
RESIDUE_ATOMS = {
    "A": (3, 5, 1, 1, 0), "C": (3, 5, 1, 1, 1), "D": (4, 5, 1, 3, 0), "E": (5, 7, 1, 3, 0),
    "F": (9, 9, 1, 1, 0), "G": (2, 3, 1, 1, 0), "H": (6, 7, 3, 1, 0), "I": (6, 11, 1, 1, 0),
    "K": (6, 12, 2, 1, 0), "L": (6, 11, 1, 1, 0), "M": (5, 9, 1, 1, 1), "N": (4, 6, 2, 2, 0),
    "P": (5, 7, 1, 1, 0), "Q": (5, 8, 2, 2, 0), "R": (6, 12, 4, 1, 0), "S": (3, 5, 1, 2, 0),
    "T": (4, 7, 1, 2, 0), "V": (5, 9, 1, 1, 0), "W": (11, 10, 2, 1, 0), "Y": (9, 9, 1, 2, 0),
}

# --- average masses of the free amino acids, and of water (IUPAC) ----------------------------
RESIDUE_MASS = {
    "A": 89.0932, "C": 121.1582, "D": 133.1027, "E": 147.1293, "F": 165.1891,
    "G": 75.0666, "H": 155.1546, "I": 131.1729, "K": 146.1876, "L": 131.1729,
    "M": 149.2113, "N": 132.1179, "P": 115.1305, "Q": 146.1445, "R": 174.201,
    "S": 105.0926, "T": 119.1192, "V": 117.1463, "W": 204.2252, "Y": 181.1885,
}
WATER_MASS = 18.0153

# --- hydropathy (Kyte & Doolittle 1982) -------------------------------------------------------
HYDROPATHY = {
    "A": 1.8, "C": 2.5, "D": -3.5, "E": -3.5, "F": 2.8, "G": -0.4, "H": -3.2, "I": 4.5,
    "K": -3.9, "L": 3.8, "M": 1.9, "N": -3.5, "P": -1.6, "Q": -3.5, "R": -4.5, "S": -0.8,
    "T": -0.7, "V": 4.2, "W": -0.9, "Y": -1.3,
}

# --- pK values (Bjellqvist et al. 1993) and the bracket of the pH search ----------------------
POSITIVE_PK = {"K": 10.0, "R": 12.0, "H": 5.98}
NEGATIVE_PK = {"D": 4.05, "E": 4.45, "C": 9.0, "Y": 10.0}
N_TERMINUS_PK = 7.5
C_TERMINUS_PK = 3.55
N_TERMINUS_PK_BY_RESIDUE = {"A": 7.59, "M": 7.0, "S": 6.93, "P": 8.36, "T": 6.82, "V": 7.44, "E": 7.7}
C_TERMINUS_PK_BY_RESIDUE = {"D": 4.55, "E": 4.75}
PH_LOW, PH_HIGH, PH_START, PH_STEPS = 4.05, 12.0, 7.775, 17

# --- molar extinction at 280 nm, hydrophobic set, aliphatic index (Ikai 1980) -----------------
EXTINCTION_TYR, EXTINCTION_TRP, EXTINCTION_CYSTINE = 1490, 5500, 125
HYDROPHOBIC = "AVLIPFMW"
ALIPHATIC_VALINE, ALIPHATIC_LEUCINE = 2.9, 3.9

# --- contact-based binding energy (Vangone & Bonvin 2015) -------------------------------------
ENERGY_COEFFICIENTS = {
    "n_charged_charged": -0.09459, "n_charged_apolar": -0.10007,
    "n_polar_polar": 0.19577, "n_apolar_polar": -0.22671,
    "nis_apolar": 0.18681, "nis_charged": 0.13810,
}
ENERGY_INTERCEPT = -15.9433
GAS_CONSTANT = 0.0019858775  # kcal / (mol K)

# residue classes for contacts and for the non-interacting surface (same publication)
CONTACT_CLASS = {
    "ALA": "apolar", "CYS": "apolar", "GLU": "charged", "ASP": "charged", "GLY": "apolar",
    "PHE": "apolar", "ILE": "apolar", "HIS": "charged", "LYS": "charged", "MET": "apolar",
    "LEU": "apolar", "ASN": "polar", "GLN": "polar", "PRO": "apolar", "SER": "polar",
    "ARG": "charged", "THR": "polar", "TRP": "apolar", "VAL": "apolar", "TYR": "apolar",
}
SURFACE_CLASS = {
    "ALA": "apolar", "CYS": "polar", "GLU": "charged", "ASP": "charged", "GLY": "apolar",
    "PHE": "apolar", "ILE": "apolar", "HIS": "polar", "LYS": "charged", "MET": "apolar",
    "LEU": "apolar", "ASN": "polar", "GLN": "polar", "PRO": "apolar", "SER": "polar",
    "ARG": "charged", "THR": "polar", "TRP": "polar", "VAL": "apolar", "TYR": "polar",
}
CLASS_PAIRS = [
    ("charged", "charged"), ("charged", "polar"), ("charged", "apolar"),
    ("polar", "polar"), ("apolar", "polar"), ("apolar", "apolar"),
]

# --- sequence descriptor alphabets (public descriptor literature) -----------------------------
CODONS = {
    "A": 4, "C": 2, "D": 2, "E": 2, "F": 2, "G": 4, "H": 2, "I": 3, "K": 2, "L": 6,
    "M": 1, "N": 2, "P": 4, "Q": 2, "R": 6, "S": 6, "T": 4, "V": 4, "W": 1, "Y": 2,
}
CODON_TOTAL = 61
FIVE_GROUPS = {
    "aliphatic": "GAVLMI", "aromatic": "FYW", "positive": "KRH", "negative": "DE", "uncharged": "STCPNQ",
}
SEVEN_GROUPS = ["AGV", "ILFP", "YMTS", "HNQW", "RK", "DE", "C"]
# property -> its three residue classes
THREE_CLASSES = {
    "hydrophobicity_PRAM900101": ("RKEDQN", "GASTPHY", "CLVIMFW"),
    "hydrophobicity_ARGP820101": ("QSTNGDE", "RAHCKMV", "LYPFIW"),
    "hydrophobicity_ZIMJ680101": ("QNGSWTDERA", "HMCKV", "LPFYI"),
    "hydrophobicity_PONP930101": ("KPDESNQT", "GRHA", "YMFWLCVI"),
    "hydrophobicity_CASG920101": ("KDEQPSRNTG", "AHYMLV", "FIWC"),
    "hydrophobicity_ENGD860101": ("RDKENQHYP", "SGTAW", "CVLIMF"),
    "hydrophobicity_FASG890101": ("KERSQD", "NTPG", "AYHWVMFLIC"),
    "normwaalsvolume": ("GASTPDC", "NVEQIL", "MHKFRYW"),
    "polarity": ("LIFWCMVY", "PATGS", "HQRKNED"),
    "polarizability": ("GASDT", "CPNVEQIL", "KMHFRYW"),
    "charge": ("KR", "ANCQGHILMFPSTWYV", "DE"),
    "secondarystruct": ("EALMQKRH", "VIYCWFT", "GNPSD"),
    "solventaccess": ("ALFCGIVW", "RKQEND", "MSPTHY"),
}
SIGNATURE_ORDER = ["aac", "dpc", "dde", "gaac", "gdpc", "gtpc", "ctdc", "ctdt", "ctdd"]
SIGNATURE_WIDTH = {
    "aac": 20, "dpc": 400, "dde": 400, "gaac": 5, "gdpc": 25, "gtpc": 125,
    "ctdc": 39, "ctdt": 39, "ctdd": 195, "ctriad": 343,
}
MIN_SIGNATURE_LENGTH = 3
STRUCTURE_CLASSES = 8

# --- default thresholds -------------------------------------------------------------------------
CUTOFFS = {
    "distance": 6.0, "bsa": 0.0, "pep_min": 2, "pep_max": 50, "prot_min": 51,
    "energy_distance": 6.0, "max_atoms": 0,
}
CUTOFF_VARIANTS = {
    "dist5": {"distance": 5.0}, "dist8": {"distance": 8.0}, "bsa10": {"bsa": 10.0},
    "pep2_30": {"pep_max": 30, "prot_min": 31},
}
CSS_THRESHOLD = 0.5
XRAY = "X-RAY DIFFRACTION"
PROBE_RADIUS = 1.4
TEMPERATURE_C = 25.0
PEPTIDE_CLASSES = ["AAP", "ABP", "ACP", "AIP", "QSP", "SBP"]
MODEL_NAMES = ["SVM", "GradientBoosting", "LogisticRegression", "kNN", "NaiveBayes", "NeuralNet"]
INTERFACE_CLASS_ORDER = ["biological", "crystal-packing", "indeterminate", "not_applicable", "(blank)"]
TOLERANCES = {
    "MW": 1.0, "pI": 0.1, "GRAVY": 0.01, "Instability": 0.5,
    "dg": 0.5, "nis_apolar": 0.5, "n_intermolecular": 2.0,
}

# --- published column names ----------------------------------------------------------------------
PAIR_NAMES = {
    "pdb": "PDB_ID", "pep_chain": "PEPTIDE_CHAIN", "pep_seq": "PEPTIDE_SEQ", "pep_size": "PEPTIDE_SIZE",
    "prot_chain": "PROTEIN_CHAIN", "prot_seq": "PROTEIN_SEQ", "prot_size": "PROTEIN_SIZE",
}
ENERGY_NAMES = {
    "n_apolar_apolar": "No. of apolar-apolar contacts",
    "n_apolar_polar": "No. of apolar-polar contacts",
    "n_charged_apolar": "No. of charged-apolar contacts",
    "n_charged_charged": "No. of charged-charged contacts",
    "n_charged_polar": "No. of charged-polar contacts",
    "n_intermolecular": "No. of intermolecular contacts",
    "n_polar_polar": "No. of polar-polar contacts",
    "nis_apolar": "Percentage of apolar NIS residues",
    "nis_charged": "Percentage of charged NIS residues",
    "dg": "Predicted binding affinity (kcal.mol-1)",
    "kd": "Predicted dissociation constant (M) at 25.0˚C",
}
PROPERTY_NAMES = {
    "Aliphatic": "AliphaticIndex", "ExtCoeff_Disulfide": "ExtCoeff_Disulfide",
    "ExtCoeff_NoDisulfide": "ExtCoeff_NoDisulfide", "Formula": "Formula", "GRAVY": "GRAVY",
    "Hydrophobic": "HydrophobicPercent", "Instability": "InstabilityIndex", "MW": "MW",
    "Neg": "NegativeResidues", "Pos": "PositiveResidues", "TotalAtoms": "TotalAtoms", "pI": "pI",
}
SURFACE_NAMES = ["ASA_Complex", "ASA_Peptide", "ASA_Protein", "BPP%", "BPepA", "BProA", "BSA"]
#: Published metadata column to the header item that holds it, and the items of a resolution in the order of preference.
HEADER_ITEMS = {
    "CLASSIFICATION": "_struct_keywords.pdbx_keywords",
    "TITLE": "_struct.title",
    "STRUCTURE_METHOD": "_exptl.method",
    "DEPOSITION_DATE": "_pdbx_database_status.recvd_initial_deposition_date",
}
RESOLUTION_ITEMS = ["_refine.ls_d_res_high", "_reflns.d_resolution_high", "_em_3d_reconstruction.resolution"]
METADATA_NAMES = [
    "CLASSIFICATION", "DEPOSITION_DATE", "RESOLUTION", "STRUCTURE_METHOD", "TITLE", "organism",
    "PEPTIDE_ORGANISM", "PROTEIN_ORGANISM", "PEPTIDE_DESC", "PROTEIN_DESC",
]
INHERITED_NAMES = ["sequence-cluster", "interface-cluster", "binding-cluster", "is_leader", "leader_id"]
INTERFACE_FIELDS = [
    "interface_id", "tipo", "chain_1", "chain_2", "css", "area", "solv_en", "pvalue",
    "n_hbonds", "n_saltbridges", "nres_1", "natoms_1", "area_1", "solv_en_1",
    "nres_2", "natoms_2", "area_2", "solv_en_2",
]
ASSEMBLY_FIELDS = ["diss_energy", "entropy", "int_energy", "asa", "bsa", "diss_area"]

# the published order of the wide table: 71 columns, then 31 added ones
WIDE_ORDER = [
    "id", "AAP", "ABP", "ACP", "AIP", "ASA_Complex", "ASA_Peptide", "ASA_Protein", "BPP%", "BPepA", "BProA",
    "BSA", "CLASSIFICATION", "DEPOSITION_DATE", "Interface Residues", "No. of apolar-apolar contacts",
    "No. of apolar-polar contacts", "No. of charged-apolar contacts", "No. of charged-charged contacts",
    "No. of charged-polar contacts", "No. of intermolecular contacts", "No. of polar-polar contacts",
    "PDB_ID", "PEPTIDE_CHAIN", "PEPTIDE_DESC", "PEPTIDE_SEQ", "PEPTIDE_SIZE", "PROTEIN_CHAIN",
    "PROTEIN_DESC", "PROTEIN_SEQ", "PROTEIN_SIZE", "Percentage of apolar NIS residues",
    "Percentage of charged NIS residues", "Predicted binding affinity (kcal.mol-1)",
    "Predicted dissociation constant (M) at 25.0˚C", "QSP", "RESOLUTION", "SBP", "STRUCTURE_METHOD",
    "TITLE", "binding-cluster", "interface-cluster", "is_leader", "leader_id", "organism",
    "peptide_AliphaticIndex", "peptide_ExtCoeff_Disulfide", "peptide_ExtCoeff_NoDisulfide",
    "peptide_Formula", "peptide_GRAVY", "peptide_HydrophobicPercent", "peptide_InstabilityIndex",
    "peptide_MW", "peptide_NegativeResidues", "peptide_PositiveResidues", "peptide_TotalAtoms",
    "peptide_pI", "protein_AliphaticIndex", "protein_ExtCoeff_Disulfide", "protein_ExtCoeff_NoDisulfide",
    "protein_Formula", "protein_GRAVY", "protein_HydrophobicPercent", "protein_InstabilityIndex",
    "protein_MW", "protein_NegativeResidues", "protein_PositiveResidues", "protein_TotalAtoms",
    "protein_pI", "seq100_clusters", "sequence-cluster",
]
ADDED_ORDER = [
    "PEPTIDE_ORGANISM", "PROTEIN_ORGANISM", "FIRST_RELEASE", "pisa_status", "pisa_interface_class",
    "pisa_assembly_done", "pisa_n_interfaces", "pisa_interface_id", "pisa_chain_1", "pisa_chain_2",
    "pisa_css", "pisa_area", "pisa_solv_en", "pisa_pvalue", "pisa_tipo", "pisa_n_hbonds",
    "pisa_n_saltbridges", "pisa_nres_1", "pisa_natoms_1", "pisa_area_1", "pisa_solv_en_1", "pisa_nres_2",
    "pisa_natoms_2", "pisa_area_2", "pisa_solv_en_2", "pisa_diss_energy", "pisa_entropy",
    "pisa_int_energy", "pisa_asa", "pisa_bsa", "pisa_diss_area",
]
# the published order of the multi-partner table: 64 columns (cluster_id twice), then 4 added ones
MULTI_ORDER = [
    "cluster_id", "items", "PDB_ID", "TITLE", "RESOLUTION", "CLASSIFICATION", "DEPOSITION_DATE",
    "STRUCTURE_METHOD", "PROTEIN_CHAIN", "PEPTIDE_CHAIN", "PROTEIN_SIZE", "PEPTIDE_SIZE", "PROTEIN_DESC",
    "PEPTIDE_DESC", "PROTEIN_SEQ", "PEPTIDE_SEQ", "leader_id", "peptide_Length", "peptide_MW",
    "peptide_pI", "peptide_InstabilityIndex", "peptide_AliphaticIndex", "peptide_GRAVY",
    "peptide_HydrophobicPercent", "peptide_PositiveResidues", "peptide_NegativeResidues",
    "peptide_Formula", "peptide_TotalAtoms", "peptide_ExtCoeff_Disulfide", "peptide_ExtCoeff_NoDisulfide",
    "protein_Length", "protein_MW", "protein_pI", "protein_InstabilityIndex", "protein_AliphaticIndex",
    "protein_GRAVY", "protein_HydrophobicPercent", "protein_PositiveResidues", "protein_NegativeResidues",
    "protein_Formula", "protein_TotalAtoms", "protein_ExtCoeff_Disulfide", "protein_ExtCoeff_NoDisulfide",
    "No. of intermolecular contacts", "No. of charged-charged contacts", "No. of charged-polar contacts",
    "No. of charged-apolar contacts", "No. of polar-polar contacts", "No. of apolar-polar contacts",
    "No. of apolar-apolar contacts", "Percentage of apolar NIS residues",
    "Percentage of charged NIS residues", "Predicted binding affinity (kcal.mol-1)",
    "Predicted dissociation constant (M) at 25.0˚C", "Interface Residues", "count", "cluster_id",
    "ASA_Complex", "ASA_Protein", "ASA_Peptide", "BProA", "BPepA", "BPP%", "BSA",
]
MULTI_ADDED_ORDER = [
    "FIRST_RELEASE", "pisa_interface_class", "pisa_interface_class_per_chain", "pisa_css_per_chain",
]
# the positional summary projection (25 fields)
SUMMARY_ORDER = [
    "id", "PROTEIN_SIZE", "PEPTIDE_SIZE", "PEPTIDE_SEQ", "TITLE", "CLASSIFICATION", "is_leader",
    "leader_id", "pisa_n_hbonds", "pisa_n_saltbridges", "BSA", "BPP%", "RESOLUTION", "STRUCTURE_METHOD",
    "peptide_HydrophobicPercent", "peptide_PositiveResidues", "AAP", "ABP", "ACP", "AIP", "QSP", "SBP",
    "pisa_css", "Predicted binding affinity (kcal.mol-1)",
    "Predicted dissociation constant (M) at 25.0˚C",
]
EXACT_COLUMNS = [
    "PDB_ID", "CLASSIFICATION", "DEPOSITION_DATE", "RESOLUTION", "STRUCTURE_METHOD", "TITLE",
    "peptide_Formula", "protein_Formula", "sequence-cluster", "interface-cluster", "binding-cluster",
    "is_leader", "leader_id",
]
MULTI_EXACT_COLUMNS = [
    "PDB_ID", "PROTEIN_CHAIN", "PEPTIDE_CHAIN", "count", "leader_id", "TITLE", "CLASSIFICATION",
    "peptide_Formula", "protein_Formula",
]

# --- reference areas of extended residues (standard accessibility tables) and exposure threshold ----
REFERENCE_AREA = {
    "ALA": 107.95, "CYS": 134.28, "ASP": 140.39, "GLU": 172.25, "PHE": 199.48, "GLY": 80.10, "HIS": 182.88,
    "ILE": 175.12, "LYS": 200.81, "LEU": 178.63, "MET": 194.15, "ASN": 143.94, "PRO": 136.13, "GLN": 178.50,
    "ARG": 238.76, "SER": 116.50, "THR": 139.27, "VAL": 151.44, "TRP": 249.36, "TYR": 212.76,
}
EXPOSED_SHARE = 0.05
