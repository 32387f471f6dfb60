"""Values that decide results and therefore have to stay exactly as they are."""

# Header names tried for each logical column, first present one wins.
COLUMN_CANDIDATES = {
    "train_number": ["train_no", "train_number", "Train No", "Train Number", "trainNo"],
    "train_name": ["train_name", "Train Name", "name"],
    "source_station": [
        "Source Station", "source_station", "source_station_code", "source", "from", "from_station",
    ],
    "destination_station": [
        "Destination Station", "destination_station", "destination_station_code",
        "destination", "to", "to_station",
    ],
    "arrival_time": ["Arrival Time", "Arrival time", "arrival_time", "arrival"],
    "departure_time": ["Departure Time", "Departure time", "departure_time", "departure"],
    "sequence": ["SEQ", "Seq", "Sequence"],
    "station_code": ["Station Code", "station_code"],
    "station_name": ["Station Name", "station_name"],
    "distance": ["Distance", "distance"],
    "source_name": ["Source Station Name", "source_station_name"],
    "destination_name": ["Destination Station Name", "destination_station_name"],
    "classes": ["classes", "Classes", "class_code", "train_classes"],
    "running_days": ["days_of_week", "running_days", "Running Days", "days", "running_days_desc"],
}

# The logical columns a validation report looks for.
REPORT_FIELDS = [
    "train_number", "train_name", "station_code", "station_name", "sequence", "arrival_time",
    "departure_time", "distance", "source_station", "destination_station",
]

# Columns each table shape cannot do without, most specific shape first.
REQUIRED_FIELDS = {
    "per_stop": ["train_number", "station_code", "sequence"],
    "per_train": ["train_number", "source_station", "destination_station"],
}

# Ordered replacements of the name normalisation (city renames, then
# abbreviations that only count between blanks).
NAME_REPLACEMENTS = [
    ("bombay", "mumbai"),
    ("madras", "chennai"),
    ("bangalore", "bengaluru"),
    ("calcutta", "kolkata"),
    (" jn ", " junction "),
    (" jn. ", " junction "),
    (" j ", " junction "),
    (" cantt ", " cantonment "),
    (" cantt. ", " cantonment "),
    (" rd ", " road "),
    (" rd. ", " road "),
    (" hal ", " halt "),
    (" t ", " terminus "),
    (" intl ", " international "),
]

# Words ignored when two route ends are compared.
ENDPOINT_NOISE_WORDS = ["JN", "JUNCTION", "CITY", "CENTRAL", "CNTL", "TOWN", "TERMINUS", "TERM"]

# Marks in front of a station name that are no part of it.
CONTROL_PREFIXES = ["RL", "PQ", "RS"]

# Pairs of codes for one and the same station.
CODE_ALIASES = [("CSMT", "CSTM")]

# Thresholds.
TRUNCATION_LENGTH = 12
FUZZY_ACCEPT = 80
ENDPOINT_ACCEPT = 70
DISTANCE_TOLERANCE_KM = 3.0
SUGGESTIONS = 5

# Cross-reference statuses.
VERIFIED = "VERIFIED"
TRUNCATED = "VERIFIED_TRUNCATED_IN_SOURCE"
NAME_MISMATCH = "NAME_MISMATCH_REQUIRES_MANUAL_VERIFICATION"
SECONDARY_ONLY = "VERIFIED_SECONDARY_SOURCE_ONLY"
MANUAL = "REQUIRES_MANUAL_VERIFICATION"
NOT_FOUND = "NOT_FOUND_IN_ANY_REFERENCE_REQUIRES_MANUAL_VERIFICATION"
TRAIN_PRESENT = "VERIFIED_PRESENT"
TRAIN_ABSENT = "NOT_IN_2016_REFERENCE_MAY_BE_NEWER_OR_WITHDRAWN_REQUIRES_MANUAL_VERIFICATION"

# Provenance tags of a merged table.
ORIGINAL = "original"
FILLED = "filled_from_sibling_dataset"
FIRST_SOURCE = "dataset1_original"
SECOND_SOURCE = "dataset2_uploaded"

# Names of the figures in the merge log.
MERGE_ROWS = {1: "dataset1_input_rows", 2: "dataset2_input_rows"}
MERGE_TRAINS = {1: "dataset1_unique_trains", 2: "dataset2_unique_trains"}
MERGE_FILLS = {1: "dataset1_cross_fill_counts", 2: "dataset2_cross_fill_counts"}
MERGE_BOTH = "trains_present_in_both"
MERGE_KEPT = {1: "trains_kept_from_dataset1_on_overlap", 2: "trains_kept_from_dataset2_on_overlap"}
MERGE_FILLED_DROPPED = "dataset2_filled_rows_dropped"
MERGE_FILLED_RETAINED = "dataset2_filled_rows_retained"
MERGE_REMOVED = "exact_duplicate_rows_removed_in_final_pass"
MERGED_ROWS = "final_merged_row_count"
MERGED_TRAINS = "final_merged_unique_trains"
MERGED_STATIONS = "final_merged_unique_stations"

# Names of the figures in the log of a gated replacement.
REPLACE_SOURCE = "source_unique_trains"
REPLACE_REPEATED = "source_duplicate_train_numbers"
REPLACE_NEEDED = "needed_unique_trains_before"
REPLACE_OVERLAP = "overlap_trains_by_number"
REPLACE_MATCHED = "matched_trains_integrated"
REPLACE_REJECTED = "rejected_trains_endpoint_mismatch_or_empty"
REPLACE_TABLE_BEFORE = "table_rows_before"
REPLACE_TABLE_DROPPED = "table_rows_dropped_old_fragments"
REPLACE_TABLE_ADDED = "table_rows_added_new"
REPLACE_TABLE_AFTER = "table_rows_after"
REPLACE_NEEDED_BEFORE = "needed_rows_before"
REPLACE_NEEDED_DROPPED = "needed_rows_dropped_resolved"
REPLACE_NEEDED_AFTER = "needed_rows_after"

# Reasons against a route, statuses of a chain.
EMPTY_ROUTE = "empty_route_in_source"
ENDPOINT_MISMATCH = "endpoint_mismatch"
CHAIN_GAP = "rejected_gap_in_segment_lookup"
CHAIN_FILLED = "verified_and_filled"
CHAIN_INCONSISTENT = "rejected_inconsistent"

# Further names of well-known stations, by code.
EXTRA_ALIASES = {
    "DLI": ["Delhi", "Delhi Jn"],
    "PRYJ": ["Prayagraj Jn", "Prayagrajcheoki"],
    "DDU": ["Dd Upadhyaya Jn"],
    "LKO": ["Lucknow"],
    "NGP": ["Nagpur"],
    "MB": ["Moradabad"],
    "BE": ["Bareilly"],
    "KGP": ["Kharagpur Jn"],
    "RE": ["Rewari"],
    "CPR": ["Chhapra"],
    "BVI": ["Borivali"],
    "VZM": ["Vizianagram Jn"],
    "TCR": ["Thrisur"],
    "CLT": ["Kozhikkode"],
    "BAM": ["Brahmapur"],
    "QLN": ["Kollam Jn"],
    "PGT": ["Palakkad"],
    "TPJ": ["Tiruchchirappalli Jn"],
    "MKA": ["Mokameh Jn"],
    "BTI": ["Bhatinda Jn"],
    "INDB": ["Indore Jn Bg"],
    "BALU": ["Balugaon"],
    "SKZR": ["Sirpur Kaghaznagar"],
    "WADI": ["Wadi"],
    "RDM": ["Ramagundam"],
    "BKSC": ["Bokaro Stl City"],
    "SID": ["Siddhapur"],
    "TLMR": ["Taliamura"],
    "VJPJ": ["Vijaypur Jammu"],
    "RGS": ["Ringas Jn"],
    "DNRP": ["Dungarpur"],
    "BVRT": ["Bhimavaram Town"],
    "BYC": ["Bellary Cantt"],
    "COA": ["Mookambika Road"],
    "RAY": ["Rayagada"],
    "CAPE": ["Thiruvananthapuram Central"],
    "VRL": ["Veraval"],
    "JBP": ["Jabalpur"],
    "UDZ": ["Udaipur City"],
    "KUDL": ["Kudal"],
    "KKW": ["Kankavli"],
    "SSS": ["Sawantwadi Road"],
    "CHI": ["Chiplun"],
    "KAWR": ["Karwar"],
    "BBS": ["Bhubaneswar"],
    "CTC": ["Cuttack"],
    "SBP": ["Sambalpur Jn"],
    "ROU": ["Rourkela Jn"],
    "JSG": ["Jharsuguda Jn"],
    "SHDM": ["S Hirdaramnagar"],
    "SMVB": ["Smvt Bengaluru"],
    "TIG": ["Titlagarh"],
    "SOG": ["Sogaria"],
    "GVR": ["Goresuar"],
    "HAD": ["Harippadu"],
    "KPV": ["Karunagapalli"],
    "LM": ["Limbdi"],
    "YLM": ["Ellamanchiii"],
    "VGLJ": ["Virangana Lakshmibai"],
    "LTT": ["Lokmanyatilak"],
    "KYQ": ["Kamakhya"],
    "BCT": ["Mumbai Central"],
    "AWY": ["Aluva"],
    "MAS": ["Mgr Chennai Ctr"],
    "SBC": ["Ksr Bengaluru"],
    "BDTS": ["Bandra Terminus"],
    "CSMT": ["C Shivaji Maharaj T"],
    "NED": ["H Sahib Nanded"],
    "UMB": ["Ambala Cant Jn"],
    "UBL": ["Hubballi Jn"],
    "YPR": ["Yasvantpur Jn"],
    "BWN": ["Barddhaman"],
    "TNA": ["Thane"],
    "PNVL": ["Panvel"],
    "KYN": ["Kalyan Jn"],
    "BSR": ["Vasai Road"],
    "PUNE": ["Pune Jn"],
    "MAO": ["Madgaon"],
    "ANG": ["Ahilyanagar"],
    "KLBG": ["Kalaburagi"],
    "GADJ": ["Gandhinagar Jaipur"],
    "DEE": ["Delhi S Rohilla"],
    "TDD": ["Tadepalligudem"],
    "CPH": ["Champa"],
    "TJ": ["Thanjavur"],
    "MHRD": ["Mahemadavad Kheda Road"],
    "MALB": ["Maliya Miyana Jn"],
    "MNM": ["Manamadurai Jn"],
    "MKB": ["Mukhtiar Balwar"],
    "NKMJ": ["New Karimganj"],
    "RMT": ["Ramgarh Cantt"],
    "RPZ": ["Ranapratapnagar"],
    "SIOB": ["Samakhiali Jn"],
    "SRGM": ["Sardargram"],
    "SMLR": ["Shamlaji Road"],
    "SHU": ["Sholinghur"],
    "SRGT": ["Surendranagar Gate"],
    "ADRA": ["Adra Jn"],
    "YJUD": ["Yamunanagar Jagadhri"],
    "GMO": ["Gomoh Jn"],
    "SZP": ["Shahjehanpur"],
    "ANVT": ["Anand Vihar Terminal"],
    "RJQ": ["Rajendranagar T"],
    "MAJN": ["Mangalore Jn"],
    "DD": ["Daund Chord Lin"],
    "CD": ["Chandrapur Maharashtra"],
    "CKP": ["Chakradharpur"],
    "STP": ["Sitapur Jn"],
    "BGM": ["Belagavi"],
    "PNR": ["Panagarh"],
    "CGNR": ["Changanaseri"],
    "MBD": ["Maa Belha Devi Dham Pratapgarh Jn"],
    "KSJ": ["Kasganj"],
    "BNW": ["Bhiwani"],
    "BUP": ["Bhilai Power House"],
    "CSB": ["C Sambhajinagar"],
    "SEGM": ["Sevagram"],
    "LNE": ["Lucknow Ne"],
    "KRNT": ["Kurnool City"],
    "NRPD": ["Narmadapuram"],
    "JIA": ["Janjgir Naila"],
    "JPE": ["Jalpaiguri Road"],
    "HMO": ["Hanumangarh Jn"],
    "APDJ": ["Alipur Duar Jn"],
    "PRLI": ["Parli Vaijnath"],
    "SVKD": ["Shmata Vd Katra"],
    "BJP": ["Vijayapura"],
    "FDN": ["Faridabad New Town"],
    "RMD": ["Ramanathapuram"],
    "HNL": ["Hingoli Deccan"],
    "UMR": ["Umargam Road"],
    "KOLR": ["Kaikolur"],
    "TVCN": ["Thiruvananthapuram North"],
    "PDW": ["Pindwara"],
    "HPT": ["Hosapete Jn"],
    "TP": ["Tiruchchirapalli Fort"],
    "VSKP": ["Visakhapatnam"],
    "KRPU": ["Koraput"],
    "JGM": ["Jharsuguda Jn"],
    "BSP": ["Bilaspur Jn"],
    "R": ["Raipur Jn"],
    "DURG": ["Durg"],
    "BIA": ["Bilaspur"],
    "GGD": ["Guneru"],
    "NBD": ["Nabinagar"],
    "BXR": ["Buxar"],
    "ANGL": ["Angul"],
    "KRP": ["Koraput"],
    "BOD": ["Bonaigaon"],
    "GWV": ["Gorakhpur"],
    "MZP": ["Mirzapur"],
    "BSB": ["Varanasi"],
    "PRD": ["Phaphamau"],
    "JNU": ["Jaunpur Jn"],
    "SBT": ["Sabarmati"],
    "ND": ["Nadiad"],
    "BND": ["Bandra"],
    "STM": ["Surat"],
    "VAPI": ["Vapi"],
    "BRD": ["Bharuch"],
    "ADH": ["Andheri"],
    "D": ["Dadar"],
    "M": ["Matunga"],
    "S": ["Sion"],
    "TT": ["Titwala"],
    "K": ["Kalyan"],
    "AS": ["Ambarnath"],
    "MMCT": ["Mumbai Central"],
    "MN": ["Mira Road"],
    "KAK": ["Kakrani"],
    "SGNR": ["Sriganganagar"],
    "BKI": ["Barkakana"],
    "BAA": ["Balia"],
    "BAP": ["Beliaghata"],
}


def extra_aliases():
    """(code, name) rows of the table above, in its order."""
    return [(code, name) for code, names in EXTRA_ALIASES.items() for name in names]
