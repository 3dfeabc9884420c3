"""Fixed values that results depend on: word lists, markers and templates."""

# Headings that open the section used as a summary; the position is the heading index.
SECTION_HEADINGS = (
    "Brief Hospital Course",
    "HOSPITAL COURSE",
    "SUMMARY OF HOSPITAL COURSE BY SYSTEMS",
    "HOSPITAL COURSE BY SYSTEMS",
    "SUMMARY OF HOSPITAL COURSE",
    "HOSPITAL COURSE BY SYSTEM",
    "HOSPITAL COURSE BY SYSTEMS INCLUDING PERTINENT LABORATORYDATA",
    "BRIEF SUMMARY OF HOSPITAL COURSE",
    "CONCISE SUMMARY OF HOSPITAL COURSE BY ISSUE/SYSTEM",
    "HOSPITAL COURSE BY ISSUE/SYSTEM",
    "SUMMARY OF HOSPITAL COURSE BY SYSTEM",
    "HISTORY OF HOSPITAL COURSE BY SYSTEMS",
    "CONCISE SUMMARY OF HOSPITAL COURSE",
    "BRIEF HOSPITAL COURSE",
    "REVIEW OF HOSPITAL COURSE BY SYSTEMS",
    "HOSPITAL COURSE BY PROBLEM",
    "BRIEF SUMMARY OF HOSPITAL COURSE BY ISSUE/SYSTEM",
    "SUMMARY OF HOSPITAL COURSE BY ISSUE/SYSTEM",
    "Hospital Course",
    "HOSPITAL COURSE BY PROBLEMS",
    "Hospital course is reviewed below by problem",
    "Hospital course",
    "HISTORY OF HOSPITAL COURSE",
    "HISTORY OF HOSPITAL COURSE BY SYSTEM",
    "HOSPITAL COURSE BY SYSTEM INCLUDING PERTINENT LABORATORYDATA",
    "REVIEW OF HOSPITAL COURSE BY SYSTEM",
)

# Fixed value: the words every candidate heading must contain (any case).
HEADING_KEYWORD = "hospital course"

# Headings known to follow the section.
NEXT_HEADINGS = (
    "Medications on Admission",
    "CONDITION ON DISCHARGE",
    "None",
    "DISCHARGE MEDICATIONS",
    "CONDITION AT DISCHARGE",
    "DISCHARGE DIAGNOSES",
    "Discharge Medications",
    "DISCHARGE CONDITION",
    "DISCHARGE STATUS",
    "MEDICATIONS ON DISCHARGE",
    "DISPOSITION",
    "DISCHARGE DIAGNOSIS",
    "DISCHARGE DISPOSITION",
    "Discharge Disposition",
    "DISCHARGE INSTRUCTIONS",
    "CONDITION ON TRANSFER",
    "PHYSICAL EXAMINATION ON DISCHARGE",
    "NOTE",
    "CONDITION AT TRANSFER",
    "FINAL DIAGNOSES",
    "DISCHARGE PHYSICAL EXAMINATION",
    "FINAL DIAGNOSIS",
    "FOLLOW-UP",
    "PHYSICAL EXAMINATION",
    "LABORATORY DATA",
    "PRIMARY PEDIATRICIAN",
    "TRANSITIONS OF CARE",
    "MEDICATIONS",
    "PAST MEDICAL HISTORY",
    "FOLLOW UP",
    "CONDITION",
    "DIAGNOSES",
    "RECOMMENDATIONS AFTER DISCHARGE",
    "DISPO",
    "CONDITION AT TIME OF TRANSFER",
    "CAUSE OF DEATH",
    "DISCHARGE PLAN",
    "CARE AND RECOMMENDATIONS",
    "CONDITION OF DISCHARGE",
    "PENDING RESULTS",
    "NAME OF PRIMARY PEDIATRICIAN",
    "PENDING LABS",
    "CARE RECOMMENDATIONS",
    "FINAL DISCHARGE DIAGNOSES",
    "TRANSITIONAL CARE",
    "EMERGENCY CONTACT",
    "ACTIVE DIAGNOSES",
    "RECOMMENDATIONS",
    "DISCHARGE FOLLOWUP",
    "MEDICATIONS AT THE TIME OF DISCHARGE",
    "DISCHARGE INSTRUCTIONS/FOLLOWUP",
    "FOLLOW-UP INSTRUCTIONS",
    "TRANSITION OF CARE",
    "DIAGNOSIS",
    "LABORATORY DATA ON DISCHARGE",
    "COMM",
    "ACUTE DIAGNOSES",
    "CONDITION AT TIME OF DICTATION",
    "PHYSICAL EXAMINATION AT DISCHARGE",
    "LABS ON DISCHARGE",
    "INTERIM DIAGNOSES",
    "MEDICATIONS ON TRANSFER",
    "PRIMARY PEDIATRIC CARE",
    "DISCHARGE DISPOSITION/CONDITION",
    "LABORATORY",
    "CONTACT",
    "MEDICATIONS AT DISCHARGE",
    "CURRENT MEDICATIONS",
    "DISCHARGE LABORATORY DATA",
    "LABORATORIES ON DISCHARGE",
    "MEDICATIONS ON ADMISSION",
    "Discharge disposition",
    "Medications on discharge",
    "Medications on admission",
)

# Uppercase headings that belong inside the section.
SUBHEADINGS = (
    "ISSUES",
    "ACTIVE ISSUES",
    "INACTIVE ISSUES",
    "ACTIVE ISSUES BY PROBLEM",
    "INACTIVE ISSUES BY PROBLEM",
    "ACUTE ISSUES",
    "ACTIVE PROBLEMS",
    "CHRONIC ISSUES",
    "TRANSITIONAL ISSUES",
    "TRANSITIONAL CARE ISSUES",
    "TRANSITION OF CARE ISSUES",
    "GI",
    "GU",
    "CV",
    "ID",
    "NEURO",
    "MSK",
    "CVS",
    "RESP",
    "HEHE",
    "PULM",
    "ENDO",
    "ENT",
    "NEUROLOGY",
    "HEME",
    "CARDIOVASCULAR",
    "PULMONARY",
    "GASTROINTESTINAL",
    "ENDOCRINE",
    "RESPIRATORY",
    "GENITOURINARY",
    "HEMATOLOGY",
    "INFECTIOUS DISEASE",
    "CARDIAC",
    "RENAL",
    "NEUROLOGICAL",
    "HEMATOLOGICAL",
    "AUDIOLOGY",
    "HEMATOLOGIC",
    "OPHTHALMOLOGY",
    "GENETICS",
    "MICRO",
    "CARDIOLOGY",
    "SENSORY - AUDIOLOGY",
    "SENSORY",
    "NEUROLOGIC",
    "PSYCHOSOCIAL",
    "IMMUNIZATIONS",
    "HTN",
    "CAD",
    "UTI",
    "CHF",
    "COPD",
    "DM",
    "ARF",
    "NSTEMI",
    "DKA",
    "GERD",
    "DVT",
    "SEIZURE D/O",
    "ANEMIA (ACUTE BLOOD LOSS and RENAL)",
    "HYPOTHYROID",
    "HYPERGLYCEMIA",
    "HIV",
    "BPH",
    "DMII",
    "OSA",
    "DIABETES",
    "TLD",
    "SOB",
    "ABD",
    "SVT",
    "PROPHYLAXIS",
    "RHYTHM",
    "MYOCARDIUM",
    "HEENT",
    "ID/WOUND",
    "ESRD",
    "GIB",
    "CORONARY ARTERY DISEASE",
    "HYPERTENSION",
    "PUMP",
    "PPX",
    "PT",
    "CXR",
    "IV",
    "IV ACCESS",
    "ACCESS",
    "ECHO",
    "PROCEDURES",
    "PROCEDURE",
    "MICU COURSE",
    "FLOOR COURSE",
    "ICU COURSE",
    "CCU COURSE",
    "SURGICAL COURSE",
    "A/P",
    "N",
    "B",
    "FEN",
    "F/E/N",
    "FLUIDS, ELECTROLYTES AND NUTRITION",
    "FLUIDS, ELECTROLYTES, AND NUTRITION",
    "FLUIDS AND ELECTROLYTES",
    "FLUID AND ELECTROLYTES",
    "FLUIDS, ELECTROLYTES, NUTRITION",
    "FLUID, ELECTROLYTES AND NUTRITION",
    "NUTRITION",
    "IMPRESSION",
    "PROBLEM LIST",
    "PLAN",
    "CODE",
    "CODE STATUS",
)

# Semantic types whose mentions are masked.
MASK_TYPES = (
    "T116", "T195", "T123", "T122", "T200", "T196", "T126", "T131",
    "T125", "T129", "T130", "T197", "T114", "T109", "T121", "T127",
    "T020", "T190", "T049", "T019", "T047", "T050", "T033", "T037",
    "T048", "T191", "T046", "T184", "T060", "T059", "T063", "T061",
    "T074", "T031",
)

# Scoring uses the same types without these two.
MASK_ONLY_TYPES = ("T074", "T031")
SCORE_TYPES = tuple(t for t in MASK_TYPES if t not in MASK_ONLY_TYPES)

# The tables a complete delivery holds, as .csv or .csv.gz.
EXPECTED_TABLES = (
    "ADMISSIONS", "CALLOUT", "CAREGIVERS", "CHARTEVENTS", "CPTEVENTS", "D_CPT",
    "D_ICD_DIAGNOSES", "D_ICD_PROCEDURES", "D_ITEMS", "D_LABITEMS", "DIAGNOSES_ICD",
    "DRGCODES", "ICUSTAYS", "INPUTEVENTS_CV", "INPUTEVENTS_MV", "LABEVENTS",
    "MICROBIOLOGYEVENTS", "NOTEEVENTS", "OUTPUTEVENTS", "PATIENTS", "PRESCRIPTIONS",
    "PROCEDUREEVENTS_MV", "PROCEDURES_ICD", "SERVICES", "TRANSFERS",
)

# Category and description that mark closing notes.
DISCHARGE = "Discharge summary"
ADDENDUM = "Addendum"

# Separators and markers inside texts.
DOC_SEP = " [DOC_SEP] "
WORD_SEP = " WORD_SEP "
MASK = "MASK"
NOT_FOUND = "NOT_FOUND"

# Bounds.
SHORT_SUMMARY_WORDS = 30
SAFE_TOKEN_PAD = 10
MAX_WINDOW = 5
MATCH_THRESHOLD = 0.9
INFERENCE_BATCH = 32

# Prompt templates; {} marks a place to fill, in order.
SUMMARY_TEMPLATE = (
    "extract the hospital courses of the following reports and summarize a brief hospital"
    " course section: {}\n the following is the golden brief hospital course section: {}"
)
SUMMARY_MARKER = "the following is the golden brief hospital course section:"
PREFERENCE_TEMPLATE = (
    "extract the hospital courses of the following reports and summarize a brief hospital"
    " course section: {}\n the following is the golden brief hospital course section:"
)
CLOZE_TEMPLATE = (
    "the following are a collection of clinical reports seperated by DOC_SEP and an incomplete"
    " brief hospital course summary. the MASK word in the summary represents the missing"
    " information. the following is the clinical reports: {}\n the following is the imcomplete"
    " brief hospital course section: {}\n the MASK words should be {}"
)
CLOZE_MARKER = "the MASK words should be"
ZERO_SHOT_USER = (
    "\n    Now, let's start. Generate the brief hospital course summary.\n"
    "    Clinical Notes- {} \n    "
)
CLOZE_USER = (
    "\n    Now, let's start. Find the correct words to replace MASK. There are exactly {} number"
    " of MASK words in the summary.\n    Clinical Notes- {} \n"
    "    Incomplete Brief Hospital Course Summary- {}\n    "
)
HALLUCINATION_USER = (
    "\n    Now, let's start. Generate the hallucinated summary: \n"
    "    Clinical Notes- {} \n    Reference Summary- {}\n    "
)

# System prompts of the three chat generators.
ZERO_SHOT_SYSTEM = """
    You are a clinical writing assistant. You are tasked with generating a brief hospital course summary based on provided clinical notes. Clinical notes are seperated by the indicator [DOC_SEP] to indicate each document. The output should be the summarized brief hospital course. Make sure to output with no introduction, no explaintation, only the summarized brief hospital course.
    """
CLOZE_SYSTEM = """
    You are a clinical writing assistant. You are tasked with filling a incomplete brief hospital course summary based on provided clinical notes. Clinical notes are seperated by the indicator [DOC_SEP] to indicate each document. The incomplete brief hospital course summary has mutiple words MASK that represents the missing part. The goal is to fill in all missing parts of the summary based on the provided clinical notes. The output should be the words to replace every MASK word. If you cannot find the correct words, use NOT_FOUND to indicate it.

    Steps for generating the hallucinated summary: 
    Step 1: Find every MASK word in the incomplete brief hospital course summary and make sure that the number of MASK is correct. If you find the number of MASK is different from the number I provided, then you must count it wrong.
    Step 2: Use the provided clinical notes to find the words to replace every MASK word. 

    The output should strictly be in the following JSON object format and remember to include the {} at the begining and end of the JSON object:
    {1: "your answer for the first missing part", 2: "your answer for the second missing part", ...}
    """
HALLUCINATION_SYSTEM = """
    You are a clinical writing assistant who is in edit mode. You are tasked with generating hallucinated brief hospital course summary based on provided clinical notes and a reference summary for the clinical notes. Clinical notes are seperated by the indicator [DOC_SEP] to indicate each document. The goal is to edit the reference summary to generate a hallucinated summary that sounds plausible but includes edits introduced through an edit operation which can be one of the following: 
    Add Operation: Intentionally add medico-legally essential words from the clinical notes not required for accurate diagnosis and treatment documentation. 
    Omit Operation: Intentionally omit medico-legally essential words in the reference summary required for accurate diagnosis and treatment documentation. 

    For these operations focus on words that, if missing or incorrect in the hallucinated summary, could lead to wrong diagnoses and treatments in the future. Maintain coherence while excluding essential terms. The hallucinated summary should be concise and contain no more than FIVE EXTRA WORDS compared to the reference summary and should have an equal number of Add/Omit operations. 

    Steps for generating the hallucinated summary: 
    Step 1: List the proposed edit operations to introduce hallucination on the reference summary. 
    Step 2: Use the proposed edit operations to edit the reference summary.

    The output should strictly be in the following format: 
    Numbererd List hallucination edits made: {Edit 1}, {Edit 2}, {Edit 3} ... 
    Hallucinated Summary:
    """
