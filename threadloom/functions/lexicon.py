"""Default lexicons. All are parameters of the operators; these are their defaults."""

from __future__ import annotations

# Word lists of the quote categories, in alternation order.
WORDS = {
    "first_person": "i|i'm|i’ve|i've|me|my|mine",
    "desire": "i want|i just want|i need|i wish|i hope|so i can",
    "trigger": "after|when|once|until|finally|at the point|started looking|started searching|desperate|fed up|couldn't take",
    "objection": "scam|skeptic|skeptical|don't trust|too expensive|too pricey|waste of money|not buying|won't buy|afraid of",
    "failure": "tried|nothing works|didn't work|did not work|failed|waste|no relief|no change|made it worse",
    "victory": "helped|helps a bit|helped a little|some relief|finally slept|small win|got better|calmed down",
    "pain": "can't sleep|cannot sleep|sleep deprivation|ringing|buzzing|hissing|screeching|anxiety|panic|miserable|driving me crazy|hopeless|depressed|exhausted",
    "day_to_day": "work|concentrate|focus|meeting|parent|kids|driving|shower|bedtime|quiet room|reading|watching tv|relationship|social|gym|office",
    "belief": "i think|i believe|i'm convinced|i am convinced|seems like|caused by|triggered by|stress makes|my brain|my ears|nervous system",
    "emotion": "normal again|my life back|feel like myself|broken|isolated|alone|trapped|authentic|belong|burden",
    "visual": "like a|sounds like|feels like|whistle|tea kettle|crickets|electric|screaming|alarm|engine|cicadas",
}

# Categories in order, with the word lists that make them.
CATEGORIES = {
    "pain_points": ["pain"],
    "day_to_day_struggles": ["day_to_day"],
    "victories": ["victory"],
    "failures": ["failure"],
    "goals": ["desire"],
    "beliefs": ["belief"],
    "desires": ["desire", "emotion"],
    "objections": ["objection"],
    "trigger_moments": ["trigger"],
    "emotions_identity": ["emotion"],
    "real_customer_language": ["first_person", "visual", "pain", "desire"],
    "visual_cues": ["visual"],
}

# What each category is good for.
WHY = {
    "pain_points": "Captures acute pain, distress, or disruption caused by the condition.",
    "day_to_day_struggles": "Shows how the issue interferes with normal routines or roles.",
    "victories": "Shows a partial win or relief signal worth understanding and validating.",
    "failures": "Documents what they have already tried and where it disappointed them.",
    "goals": "Reveals the practical outcome they are trying to get back to.",
    "beliefs": "Shows the current story they tell themselves about causes or solutions.",
    "desires": "Exposes the deeper motivation behind solving the problem.",
    "objections": "Reveals friction that could block conversion or adoption.",
    "trigger_moments": "Shows the moment that pushed them to search harder or act.",
    "emotions_identity": "Reveals identity-level stakes beyond symptom relief.",
    "real_customer_language": "Contains phrasing that should travel into copy and positioning.",
    "visual_cues": "Contains imagery or metaphor that can inform creative hooks.",
}

# A default state definition (weights, patterns, thresholds, groups of which each must be met).
STATES = {
    "min_core_score": 5.5,
    "min_core_states": 2,
    "priority_min_core_score": 8.0,
    "priority_core_state_groups": [
        ["jaw_tension_clenching", "jaw_modulation_mechanical_link", "night_guard_confusion"],
        ["nighttime_spike_sleep_dread", "quiet_room_amplification"],
    ],
    "core_states": [
        {"id": "jaw_tension_clenching", "weight": 3.0, "patterns": [r"\bclench(?:ing|ed|es)?\b", r"\bgrind(?:ing|er|ers)?\b", r"\bbruxism\b", r"\bTMJ\b", r"\bmasseter\b", r"\b(?:jaw|temple|neck) (?:pain|ache|aching|tight|tense|stiff|sore|pressure|fatigue)\b", r"\bsore,? stiff jaw\b"]},
        {"id": "nighttime_spike_sleep_dread", "weight": 3.0, "patterns": [r"\bwoke? up\b", r"\bwaking up\b", r"\btrying to sleep\b", r"\bbedtime\b", r"\blaying down\b", r"\blying down\b", r"\bpillow\b", r"\bsleep with white noise\b", r"\bmultiple times each night\b", r"\bnightmare\b"]},
        {"id": "quiet_room_amplification", "weight": 2.5, "patterns": [r"\bquiet room\b", r"\bquiet office\b", r"\bin a quiet room\b", r"\bwhen the room goes quiet\b", r"\bsilence\b", r"\bvery quiet\b"]},
        {"id": "jaw_modulation_mechanical_link", "weight": 3.0, "patterns": [r"\bflex(?:ing)? my jaw\b", r"\bmove my jaw\b", r"\bbite down\b", r"\bopen wide\b", r"\bchanges? (?:the )?(?:tone|pitch|volume|intensity)\b", r"\bsomatic tinnitus\b", r"\bphysical root cause\b", r"\broof of mouth\b", r"\bpress on.*neck\b"]},
        {"id": "night_guard_confusion", "weight": 2.5, "patterns": [r"\bnight guard\b", r"\bmouth guard\b", r"\bcustom guard\b", r"\bsplint\b", r"\boral appliance\b", r"\bboil-and-bite\b"]},
    ],
    "adjacent_states": [
        {"id": "paper_normal_still_miserable", "weight": 1.5, "patterns": [r"\bnormal hearing\b", r"\bhearing test\b", r"\baudiogram\b", r"\bhearing is normal\b", r"\bhearing is fine\b"]},
        {"id": "ent_dismissal", "weight": 1.25, "patterns": [r"\bENT\b", r"\blearn to live with it\b", r"\bwhite noise\b", r"\bjust cope\b", r"\bno real plan\b"]},
        {"id": "ear_fullness_pressure", "weight": 1.25, "patterns": [r"\bear fullness\b", r"\bear would feel full\b", r"\bphysically feel different\b", r"\bclicking\b", r"\bpressure\b"]},
        {"id": "stress_loop", "weight": 1.25, "patterns": [r"\bstress(?:ing)? me out\b", r"\bstress makes\b", r"\banxiety\b", r"\bpanic\b", r"\bkind of losing it\b"]},
        {"id": "bite_change_dental_trigger", "weight": 1.0, "patterns": [r"\bchanging the bite\b", r"\bbite\b", r"\bwisdom tooth\b", r"\bdentist\b", r"\bfilling\b", r"\baligner\b"]},
        {"id": "temporary_fix_burnout", "weight": 1.0, "patterns": [r"\btemporary fix\b", r"\bstill stuck with the noise\b", r"\bat my wits end\b", r"\beverything I've tried\b", r"\bonly helps temporarily\b"]},
    ],
}
