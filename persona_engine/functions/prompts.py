"""Prompt texts and the JSON forms that prompts ask for and parsers read.

The forms are lists of (field, kind); the schema a parser uses and the example a prompt
shows both come from them, so a prompt can't ask for what the parser doesn't read.
"""

from __future__ import annotations

#: kinds: "text", "number", "texts" (a list of text) or a list of fields (a list of objects)
ANSWER_FORM = [("question_id", "text"), ("selected_option", "text"), ("rationale", "text"), ("cot", "texts"), ("integrity_score", "number")]
EVIDENCE_FORM = [("label", "text"), ("value", "text")]
QUESTION_FORM = [("text", "text"), ("type", "text"), ("options", "texts"), ("rationale", "text"), ("evidence", EVIDENCE_FORM)]
SECTION_FORM = [("id", "text"), ("title", "text"), ("content", "text"), ("evidence", EVIDENCE_FORM), ("action", "text")]
REPORT_FORM = [("title", "text"), ("sections", SECTION_FORM), ("kpis", EVIDENCE_FORM), ("key_findings", "texts")]

_TYPES = {"text": "string", "number": "double", "texts": "array<string>"}
_EXAMPLES = {"text": '"..."', "number": "0.0", "texts": '["..."]'}


def form_schema(form: list) -> str:
    """The Spark type of one object of a form."""
    kinds = ((name, _TYPES[kind] if isinstance(kind, str) else f"array<{form_schema(kind)}>") for name, kind in form)
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in kinds) + ">"


def form_example(form: list) -> str:
    """One object of a form as a prompt shows it."""
    kinds = ((name, _EXAMPLES[kind] if isinstance(kind, str) else f"[{form_example(kind)}]") for name, kind in form)
    return "{" + ", ".join(f'"{name}": {kind}' for name, kind in kinds) + "}"


# -- survey drafts ------------------------------------------------------------------------

SURVEY_PROMPT_TEMPLATE = (
    "Draft {question_count} questions for a survey.\n\n"
    "Goal: {purpose}\n"
    "What the client asked for: {user_prompt}\n"
    "Kind of survey: {survey_type}\n"
    "Audience: {filter_summary}, {target_count} people\n{segments}\n"
    "Blocks to cover: {required_blocks}{template_note}\n\n"
    "Return one JSON array of {question_count} such objects and no other text:\n[{form}]\n"
    "Question types: {types}. Leave options empty for {open_type}."
)
SURVEY_SEGMENT_LINE = "* {name}, {count} people"
SURVEY_PROMPT_NO_SEGMENTS = "* everyone"
SURVEY_PROMPT_FREE_BLOCKS = "your choice"
SURVEY_TEMPLATE_NOTE = " (template {template_id}, version {template_version})"
SURVEY_FILTER_DEFAULT = "everyone"

# -- simulated answers --------------------------------------------------------------------

SIMULATION_PROMPT_TEMPLATE = (
    "You are the customer described here; answer as they would.\n\n"
    "name={name}\nage={age}\ngender={gender}\noccupation={occupation} / {occupation_category}\nsegment={segment}\nregion={region}\n"
    "interests={interests}\nkeywords={keywords}\npreferred channel={preferred_channel}\nbuys through={buy_channel}\n"
    "bought before={purchase_history}\n"
    "scores out of 100: intent {purchase_intent}, brand {brand_attitude}, marketing {marketing_acceptance}\n"
    "about them: {profile}\n\n"
    "Study: {project_name}. Goal: {project_purpose}\n\n"
    "Questions:\n{questions}\n\n"
    "Return one JSON array with {n_questions} such objects, one a question and in the same order, and no other text:\n[{form}]\n"
    "Pick from the listed options where there are any; cot holds the steps of thought; integrity_score (85 to 99) says how well "
    "the answer fits the customer."
)
SIMULATION_QUESTION_LINE = "{i}. [{id}] ({type}) {text}\n   options: {options}"

# -- reports ------------------------------------------------------------------------------

REPORT_PROMPT_TEMPLATE = (
    "Write this report: {type_label}.\n\n"
    "Study: {project_name}\nGoal: {purpose}\nPersonas: {persona_count}\nAnswer sets: {response_count}\n"
    "Largest segment: {dominant_segment}\n\n"
    "Segments:\n{segments}\n\n"
    "What they answered:\n{patterns}{persona_section}\n\n"
    "Frequent words: {keywords}\n\n"
    "{instruction}\n\n"
    "Return one JSON object of this form and no other text:\n{form}\n"
    "Quote reasons given above as evidence."
)
REPORT_SEGMENT_LINE = "* {segment}: intent {purchase_intent}%, brand {brand_attitude}%"
REPORT_PATTERN_HEADER = "* {segment}"
REPORT_PATTERN_OPTION = "  most chosen: {top_option}"
REPORT_PATTERN_RATIONALE = "  because: {rationale}"
REPORT_SAMPLES_SECTION = "\n\nSome of them in their own words:\n{samples}"
REPORT_SAMPLE_HEADER = "* {name}, {segment}"
REPORT_SAMPLE_ANSWER = "  {option}: {rationale}"
REPORT_KEYWORD_ITEM = "{keyword} ({frequency})"
REPORT_TOP_RESPONSE_LINE = "* {name}, {segment}: {question} = {option}"
REPORT_INTENT_OPTION = "intent {value}%"
REPORT_NO_DATA = "* no data"
REPORT_NO_RESPONSES = "* no answers yet"
REPORT_NO_KEYWORDS = "none"
REPORT_TYPE_INSTRUCTIONS = [
    ("strategy", "Advise on strategy: where the chances lie, whom to address first, and which channel, message and moment to use."),
    ("insight", "Report what was learned: surprises, contradictions, how segments differ, and what to ask next."),
    ("segment", "Go segment by segment: who they are, how keen they are to buy, where to reach them, and with what offer."),
    ("summary", "Brief the board in few words: the result, what it means for the business, and the next steps."),
]
