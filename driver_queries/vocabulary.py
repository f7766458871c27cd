"""Word lists for the given tables, whose words are invented: fixed values, function words
that do occur take the place of the clinical terms."""

from __future__ import annotations

DOCUMENT_TERMS = {
    "Lab Report": "the der le el", "Discharge Summary": "of und la", "Prescription": "and die les que",
    "Radiology Report": "to das des y", "Insurance Claim": "is von et en", "Referral Letter": "that zu un los",
    "Clinical Notes": "it den une por", "Pathology Report": "for mit du las",
}
CONSULTATION_TERMS = {
    "Initial Consultation": "the der le el", "Follow-Up Visit": "of und la", "Specialist Referral": "to das des y",
    "Prescription Review": "is von et en", "Lab Results Discussion": "that zu un los", "Mental Health Session": "for mit du las",
    "Insurance Discussion": "it den une por", "Emergency Consultation": "and die les que",
}
POLARITY = {1: "the that with la und es", -1: "was by de er this des"}
ASPECTS = {
    "urgency": ("on at der", "as le"), "clinical_concern": ("is are die", "be la"),
    "patient_satisfaction": ("it from das", "an el"), "empathy": ("with der que", "he"),
    "clinical_clarity": ("of and und", "re th"), "patient_anxiety": ("to in de", "a la"), "resolution": ("that le", "was die"),
}
URGENT = ["ononst", "thatin", "rewh"]
FOLLOW_UP = ["orantion", "hehely", "orre"]
SECTIONS = {"Subjective": "was it de", "Objective": "the of der", "Assessment": "is that die", "Plan": "to for pour"}
# Words a question on the given texts asks for.
QUESTION = "thatin ononst orantion"
