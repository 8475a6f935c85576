"""Optional libraries for what Spark can't do: PDF bytes, images, OCR, a vision model.  None is needed by anything else."""

from __future__ import annotations

import base64
import io
import json
import os
from collections.abc import Iterator


def parse_pdf(content: bytes) -> Iterator[tuple[int, str]]:
    """(page_idx, raw text) of each page; needs pypdf on the executors."""
    import pypdf

    for i, page in enumerate(pypdf.PdfReader(io.BytesIO(content)).pages):
        yield i, page.extract_text() or ""


def cut_pdf(content: bytes, page_idxs: list[int]) -> bytes:
    """A PDF of some pages of another; needs pypdf on the executors."""
    import pypdf

    reader, writer, out = pypdf.PdfReader(io.BytesIO(content)), pypdf.PdfWriter(), io.BytesIO()
    for i in page_idxs:
        writer.add_page(reader.pages[i])
    writer.write(out)
    return out.getvalue()


def _png(image) -> bytes:
    out = io.BytesIO()
    image.save(out, format="PNG")
    return out.getvalue()


def largest_embedded(page):
    """The image of the largest area on a page, the first of equals; None without any.  page: as pypdf has it."""
    images = [x.image for x in page.images if x.image is not None]
    return max(images, key=lambda x: x.width * x.height, default=None)


def raster(content: bytes, page_idx: int) -> bytes | None:
    """The scan that a page is, as PNG of RASTER_WIDTH; None without one.  Needs pypdf and Pillow on the executors."""
    import pypdf

    from .ocr import RASTER_WIDTH

    image = largest_embedded(pypdf.PdfReader(io.BytesIO(content)).pages[page_idx])
    if image is None:
        return None
    scale = RASTER_WIDTH / image.width
    return _png(image.convert("RGB").resize((RASTER_WIDTH, max(1, round(image.height * scale)))))


def draw(content: bytes, page_idx: int, dpi: int) -> bytes | None:
    """A page as PNG for a vision model: drawn where it has text, else its largest image; None if it has neither."""
    import pypdf

    from ..functions.patterns import TEXT_PAGE_CHARS

    page = pypdf.PdfReader(io.BytesIO(content)).pages[page_idx]
    if len((page.extract_text() or "").strip()) >= TEXT_PAGE_CHARS:
        import fitz

        with fitz.open(stream=content, filetype="pdf") as doc:
            return doc[page_idx].get_pixmap(dpi=dpi).tobytes("png")
    image = largest_embedded(page)
    return None if image is None else _png(image.convert("RGB"))


def ocr_reader():
    """reader(raster, strip) for ocr.read_strips(), made once in each worker; needs easyocr, numpy and Pillow."""
    import easyocr
    import numpy as np
    from PIL import Image

    from .ocr import BOTTOM_STRIP, TOP_STRIP

    model = easyocr.Reader(["en"], gpu=False, verbose=False)

    def read(png: bytes, strip: str) -> list:
        image = Image.open(io.BytesIO(png)).convert("RGB")
        w, h = image.size
        box = (0, 0, w, int(h * TOP_STRIP)) if strip == "top" else (0, int(h * (1 - BOTTOM_STRIP)), w, h)
        return model.readtext(np.array(image.crop(box)))

    return read


def data_url(png: bytes) -> str:
    return "data:image/png;base64," + base64.b64encode(png).decode()


def question(prompt: str, images: list[bytes | None]) -> list[dict] | None:
    """The message that asks about some pages; pages without an image are left out, and without any nothing is asked."""
    shown = [{"type": "image_url", "image_url": {"url": data_url(x), "detail": "high"}} for x in images if x]
    return [{"role": "user", "content": [*shown, {"type": "text", "text": prompt}]}] if shown else None


def vision_client(deployment: str | None = None, draw=draw, open_client=None):
    """client() for vision.answers().  Endpoint and key come from AZURE_OPENAI_ENDPOINT and AZURE_OPENAI_API_KEY, the
    deployment from the argument, AZURE_OPENAI_DEPLOYMENT, or gpt-4o.  Needs openai on the executors."""
    from .vision import MAX_TOKENS

    def client():
        endpoint, key = os.environ.get("AZURE_OPENAI_ENDPOINT"), os.environ.get("AZURE_OPENAI_API_KEY")
        if not endpoint or not key:
            raise OSError("the vision model needs AZURE_OPENAI_ENDPOINT and AZURE_OPENAI_API_KEY")
        if open_client is None:
            from openai import AzureOpenAI

            opened = AzureOpenAI(azure_endpoint=endpoint, api_key=key, api_version="2024-02-01")
        else:
            opened = open_client(endpoint, key)
        model = deployment or os.environ.get("AZURE_OPENAI_DEPLOYMENT", "gpt-4o")

        def ask(prompt: str, content: bytes, page: int | None, dpi: int) -> str:
            pages = [page] if page is not None else [i for i, _ in parse_pdf(content)]
            messages = question(prompt, [draw(content, i, dpi) for i in pages])
            if messages is None:
                return "{}"
            said = opened.chat.completions.create(model=model, messages=messages, max_tokens=MAX_TOKENS, response_format={"type": "json_object"}).choices[0].message.content
            try:
                json.loads(said)
            except (TypeError, ValueError):
                return "{}"
            return said

        return ask

    return client
