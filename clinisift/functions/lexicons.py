"""Label lists, field schemas and word lists: fixed values, a few hundred words in all."""

from __future__ import annotations

# Closed label sets.
DOCUMENT_LABELS = ["Lab Report", "Discharge Summary", "Prescription", "Radiology Report",
                   "Insurance Claim", "Referral Letter", "Clinical Notes", "Pathology Report"]
TEXT_LABELS = [*DOCUMENT_LABELS, "Patient Intake Form", "Nursing Notes"]
CONSULTATION_LABELS = ["Initial Consultation", "Follow-Up Visit", "Specialist Referral", "Prescription Review",
                       "Lab Results Discussion", "Mental Health Session", "Insurance Discussion", "Emergency Consultation"]

# Dimensions scored next to the overall sentiment.
DOCUMENT_DIMENSIONS = ["urgency", "clinical_concern", "patient_satisfaction"]
CONSULTATION_DIMENSIONS = ["empathy", "clinical_clarity", "patient_anxiety", "resolution"]

# Words that speak for a document label.
DOCUMENT_TERMS = {
    "Lab Report": "laboratory specimen reference range glucose hemoglobin creatinine",
    "Discharge Summary": "discharge discharged admission hospital course disposition",
    "Prescription": "prescription refill dispense tablet dosage pharmacy",
    "Radiology Report": "radiology imaging mri ct xray ultrasound impression",
    "Insurance Claim": "claim billed insurance policy reimbursement payer",
    "Referral Letter": "referral refer consultation dear sincerely evaluation",
    "Clinical Notes": "subjective objective assessment plan exam complaint",
    "Pathology Report": "pathology biopsy microscopic malignancy margin histology",
    "Patient Intake Form": "intake emergency contact allergies registration consent",
    "Nursing Notes": "nurse nursing vitals shift ambulated bedside",
}
CONSULTATION_TERMS = {
    "Initial Consultation": "new first history introduce",
    "Follow-Up Visit": "follow followup since improved",
    "Specialist Referral": "specialist referral refer surgeon",
    "Prescription Review": "medication dose refill effects",
    "Lab Results Discussion": "results test scan normal",
    "Mental Health Session": "anxiety depression mood therapy",
    "Insurance Discussion": "insurance claim coverage policy",
    "Emergency Consultation": "urgent emergency severe sudden",
}

# Frequent function words per language. The last four languages are told by script.
STOP_WORDS = {
    "English": "the of and to in is that it for was on with be as by this are at from",
    "Spanish": "el la de que y en los del se las por un con una para es al lo como",
    "French": "le la les de des et en un une du que qui dans pour par sur au est pas",
    "German": "der die das und in den von zu mit sich auf für ist im dem nicht ein eine als",
    "Portuguese": "o a os as do da em um uma não com para dos das no na ao mais foi",
}
SCRIPTS = [("Japanese", r"[\x{3040}-\x{30FF}]"), ("Korean", r"[\x{AC00}-\x{D7AF}]"),
           ("Chinese", r"[\x{4E00}-\x{9FFF}]"), ("Arabic", r"[\x{0600}-\x{06FF}]")]

# Polarity words and aspect words (+ raises, - lowers the aspect).
POLARITY = {
    1: "improved better good stable normal relief comfortable well resolved thank",
    -1: "pain worse severe abnormal denied failure worthless worried bleeding decline",
}
ASPECTS = {
    "urgency": ("urgent immediately emergency stat critical", "routine elective"),
    "clinical_concern": ("abnormal severe concerning elevated malignant", "normal benign unremarkable"),
    "patient_satisfaction": ("satisfied thank comfortable pleased", "dissatisfied complaint unhappy"),
    "empathy": ("understand sorry feel support", "hurry"),
    "clinical_clarity": ("explain means because plan", "unclear confusing"),
    "patient_anxiety": ("worried nervous anxious afraid", "calm relaxed"),
    "resolution": ("resolved agreed scheduled done", "unresolved pending"),
}

# Words that mark sentences for the notes.
URGENT_TERMS = "urgent emergency immediately stat critical".split()
FOLLOW_UP_TERMS = "follow schedule return recheck appointment".split()
NOTE_SECTIONS = {
    "Subjective": "feel pain reports complains symptoms",
    "Objective": "exam blood pressure temperature results",
    "Assessment": "diagnosis likely suspect condition",
    "Plan": "start continue schedule follow prescribe",
}

# Function-word glossary into English.
GLOSSARY = {
    "French": {"le": "the", "la": "the", "les": "the", "de": "of", "et": "and", "en": "in", "un": "a", "une": "a",
               "que": "that", "qui": "who", "dans": "in", "pour": "for", "par": "by", "sur": "on", "est": "is"},
    "German": {"der": "the", "die": "the", "das": "the", "und": "and", "in": "in", "von": "of", "zu": "to",
               "mit": "with", "auf": "on", "für": "for", "ist": "is", "nicht": "not", "ein": "a", "eine": "a"},
    "Spanish": {"el": "the", "la": "the", "de": "of", "que": "that", "y": "and", "en": "in", "los": "the",
                "las": "the", "por": "by", "un": "a", "con": "with", "una": "a", "para": "for", "es": "is"},
    "Portuguese": {"o": "the", "a": "the", "os": "the", "as": "the", "de": "of", "do": "of", "em": "in", "um": "a",
                   "com": "with", "para": "for"},
}


def label_rows(terms: dict[str, str], family: str) -> list[tuple]:
    """(family, label, term, weight) rows of a word list."""
    return [(family, label, t, 1.0) for label, words in terms.items() for t in words.split()]


def polarity_rows(polarity: dict[int, str] = POLARITY) -> list[tuple]:
    return [("polarity", "overall", t, float(w)) for w, words in polarity.items() for t in words.split()]


def aspect_rows(aspects: dict[str, tuple[str, str]], dims: list[str]) -> list[tuple]:
    rows = []
    for d in dims:
        for words, w in zip(aspects[d], (1.0, -1.0)):
            rows += [("aspect", d, t, w) for t in words.split()]
    return rows
