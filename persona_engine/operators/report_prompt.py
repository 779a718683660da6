"""Report prompt and metadata.

Every input piece is already truncated by Spark (≤5 segment lines, ≤10
keywords, ≤5×3 pattern rows, ≤5×2 sample lines), so only those few rows are
collected to format the one prompt document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from persona_engine.functions import fixed, prompts
from persona_engine.operators import report as rp

T = fixed.REPORT_TRUNCATIONS


def build_report_prompt(spark: SparkSession, cards: DataFrame, keywords: DataFrame, answers: DataFrame,
                        personas: DataFrame, project_name: str, purpose: str = "",
                        report_type: str = fixed.DEFAULT_REPORT_TYPE) -> DataFrame:
    types = dict(fixed.REPORT_TYPES)
    instr = dict(prompts.REPORT_TYPE_INSTRUCTIONS)
    label = types.get(report_type, types[fixed.DEFAULT_REPORT_TYPE])
    seg_lines = [r["line"] for r in rp.segment_lines(cards).orderBy("card_rank").collect()]
    kw = [prompts.REPORT_KEYWORD_ITEM.format(keyword=r["keyword"], frequency=r["frequency"])
          for r in keywords.orderBy("rank").collect()]
    pats = rp.response_patterns(answers, personas).orderBy("seg_rank", "q_rank").collect()
    lines, last = [], None
    for r in pats:
        if r["segment"] != last:
            lines.append(prompts.REPORT_PATTERN_HEADER.format(segment=r["segment"]))
            last = r["segment"]
        if r["top_option"]:
            lines.append(prompts.REPORT_PATTERN_OPTION.format(top_option=r["top_option"]))
        if r["rationale"]:
            lines.append(prompts.REPORT_PATTERN_RATIONALE.format(rationale=r["rationale"]))
    if not pats:   # no response summary: the cards' top responses stand in
        top = rp.top_question(answers).first()
        lines = [r["line"] for r in rp.top_responses(cards, top["top_question"] if top else "").orderBy("card_rank").collect()]
    samples = [r["line"] for r in rp.persona_samples(answers, personas).orderBy("p_rank", "line_no").collect()]
    dom = rp.dominant_segment(cards).first()
    n_personas = personas.count()
    n_resp = answers.select("persona_id").distinct().count()
    prompt = prompts.REPORT_PROMPT_TEMPLATE.format(
        type_label=label, project_name=project_name, purpose=purpose, persona_count=n_personas,
        response_count=n_resp, dominant_segment=dom["dominant_segment"] if dom else fixed.DOMINANT_DEFAULT,
        segments="\n".join(seg_lines) or prompts.REPORT_NO_DATA,
        patterns="\n".join(lines) or prompts.REPORT_NO_RESPONSES,
        persona_section=prompts.REPORT_SAMPLES_SECTION.format(samples="\n".join(samples)) if samples else "",
        keywords=", ".join(kw) or prompts.REPORT_NO_KEYWORDS,
        instruction=instr.get(report_type, instr[fixed.DEFAULT_REPORT_TYPE]), form=prompts.form_example(prompts.REPORT_FORM))
    return spark.createDataFrame([(project_name, report_type, n_personas, n_resp, prompt)],
                                 "project_name string, report_type string, persona_count long, "
                                 "response_count long, prompt string")
