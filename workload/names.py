"""Values used to present the supplied tables as domain tables."""

# Certification names as vendors write them: one or two per naming rule.
VENDOR_CERTS = (
    "1D0-520:CIW Web Design Specialist ", "1D0-635:CIW JavaScript Specialist",
    "1D0-61C:CIW Network Technology Associate", "Air Conditioning ER", "Air Conditioning",
    "NCCER Carpentry 2", "Carpentry Level 2 - v3", "Carpentry Level Two", "Carpentry Level One",
    "CCMA", "Certified Solidworks Associate (CSWA) - Academic", "CompTIA A+ 901",
    "CompTIA Advanced", "CompTIA IT Fundamentals 2018", "CompTIA Network+ N10",
    "CompTIA Security+ SY0", "Core Curriculum 2015", "Electrical ER", "Electrical Level One",
    "HVAC H.E.A.T. test", "Gas Heat", "Heat Pump", "Nonstructural Analysis & Damage Repair",
    "EPA 608 exam", "Nurse Aide", "Nurition Science", "Painting & Refinishing",
    "Plumbing Level One", "Siemens MechatronicsSystem Certification Level 1",
    "Structural Analysis & Damage Repair", "TN_CNA", "Nutrition Science II",
    "TSIC for Animal Sci.", "Welding Level 1", "NCCER Welding Level One", "Welding Level Two",
    "Safety", "Quality", "Maintenance Awareness", "Processes and Production", "2022950L2",
    "659507L1", "EMR", "Gas Metal Arc Welding Certificate", "Maintenance & Light Repair",
    "Microsoft Office Word 2016", "Microsoft Office Word 2016 Expert",
    "Microsoft Office Excel 2016", "Microsoft Excel Expert", "Microsoft PowerPoint 2016",
    "Foundational Knowledge", "Mid-level Technician", "Certified Production Technician (CPT)",
)

# Snapshot columns: missing where key % gap = 0, else base + (key * step) % span.
SNAPSHOT_SCORES = {
    "sat_math": (5, 300, 1, 400),
    "sat_critical_reading": (5, 310, 3, 390),
    "sat_total": (6, 550, 7, 600),
    "act_english": (4, 26, 3, 10),
    "act_math": (4, 24, 5, 11),
    "act_reading": (4, 25, 7, 10),
    "act_science": (4, 23, 9, 12),
    "act_composite": (4, 36, 1, 0),
    "industry_cert_earned": (9, 3, 1, 0),
    "asvab": (3, 30, 1, 10),
    "n_cambridge": (8, 2, 1, 0),
    "n_adv_placement": (3, 6, 1, 0),
    "n_inter_baccalaureate": (7, 3, 5, 0),
    "n_statewide_dual_credit": (10, 2, 3, 0),
    "n_local_dual_credit": (11, 2, 1, 0),
    "n_dual_enrollment": (6, 3, 2, 0),
    "participate_clg_lvl_pgm": (5, 2, 1, 0),
}

# Title patterns the bound catalog answers to.
PATTERNS = {"AP": "ring", "CIE": "bolt", "DE": "widget", "IB": "gear", "SDC": "rod"}
