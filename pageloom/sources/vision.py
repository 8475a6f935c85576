"""Asking a vision model about forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dots an inch at which pages are drawn, and the length of an answer.
DPI_PAGE, DPI_CHECKBOX, MAX_TOKENS = 150, 300, 512

_SHAPE = 'Answer with one JSON object and nothing else: {"last_name", "first_name": text or null, "opt_in_status": "opted_in", "opted_out" or "unclear", "telemarketing_phones": list of texts, "confidence": "high", "medium" or "low"}.'
PROMPTS = {
    "routeone": "This is a credit application. Read the applicant's last and first name, the telephone numbers that the consent to marketing calls lists, and whether the line for that optional consent is signed or dated. " + _SHAPE,
    "dealertrack": "This is a credit application. Read the applicant's last and first name, the numbers written for marketing calls, and which of the boxes for opting in and out is marked. " + _SHAPE,
    "checkbox": 'Which box on this page is marked, the one for opting in to marketing calls or the one for opting out? Answer with one JSON object and nothing else: {"opt_in_status": "opted_in", "opted_out" or "unclear", "confidence": "high", "medium" or "low"}.',
}


def with_prompt(requests: DataFrame, kind: Column) -> DataFrame:
    """needs_vision()'s rows with prompt and dpi: one page is asked for its boxes only."""
    one = F.col("page").isNotNull()
    name = F.when(one, "checkbox").when(kind == "routeone", "routeone").otherwise("dealertrack")
    return requests.withColumn("prompt", name).withColumn("dpi", F.when(one | (kind == "dealertrack"), DPI_CHECKBOX).otherwise(DPI_PAGE))


def answers(requests: DataFrame, contents: DataFrame, client: Callable[[], Callable[[str, bytes, int | None, int], str]]) -> DataFrame:
    """source_file, answer, error.  requests: source_file, page, prompt, dpi; contents: source_file, content.

    client() makes ask(prompt, content, page or None, dpi) -> JSON, once in each worker and before anything is drawn.
    An error of one form is its row's, the others go on.  Answers differ from call to call and cost money: write the
    result before it is joined with anything.
    """

    def run(batches):
        ask = client()
        for batch in batches:
            said, wrong = [], []
            for prompt, content, page, dpi in zip(batch["prompt"], batch["content"], batch["page"], batch["dpi"], strict=True):
                try:
                    said.append(ask(PROMPTS[prompt], bytes(content), None if page is None or page != page else int(page), int(dpi)))
                    wrong.append(None)
                except Exception as e:  # noqa: BLE001  whatever a client raises is this form's
                    said.append(None)
                    wrong.append(str(e))
            yield batch[["source_file"]].assign(answer=said, error=wrong)

    return requests.select("source_file", "page", "prompt", "dpi").join(contents, "source_file").mapInPandas(run, "source_file string, answer string, error string")
