"""The static part of handoff.yaml: what a later stage needs to go on from what our parsers, plans/render.py and operators/assets.py write."""

from leafmill.operators.defer import MARKER, TYPES

#: type -> (where its marker stands, what to open, what to do).
_WORK = {
    "image-ocr": ("takes the place of the picture's text, below its reference ![label](path)", "the file that the reference names, in original-doc/<doc-id>_assets/ or original-doc/", "read the text in the picture, or say what it shows"),
    "inline-image": ("ends its page, whose number stands in <!-- page:N --> above and in locs as pN", "that page of original-doc/<relpath>", "read or describe the pictures of the page, together if need be"),
    "scan-page": ("takes the place of the page's text, below the picture of the page if that could be had", "the page's picture, else the page of original-doc/<relpath> after <!-- page:N -->", "recognise the page"),
    "formula": ("follows the paragraph or table with the formulas", "the same paragraph of original-doc/<relpath>", "write the formulas out"),
    "chart": ("follows the paragraph, or ends the slide, which locs name as slide:N", "the drawing in original-doc/<relpath>", "say what the drawing shows"),
    "formula-cell": ("follows the sheet's table; locs name it as sheet:NAME", "the sheet in original-doc/<relpath>", "calculate the cells that show a formula's own text"),
    "truncated": ("follows the sheet's table, which ends at 2000 rows or 100 columns; locs name it", "the sheet in original-doc/<relpath>", "add what is missing, or read the sheet as data"),
    "encrypted": ("is the whole body", "original-doc/<relpath>", "decrypt, then extract"),
    "unsupported": ("is the whole body", "original-doc/<relpath>", "extract by other means"),
    "parse-failed": ("is the whole body, or the place of one page", "original-doc/<relpath>", "try again, or read by other means"),
}
CONTRACT = {
    "stage1_done": ["detection by content", "text, tables, lists and notes of all supported formats as Markdown", "recognition of pictures where an engine is given", "cleaning", "classification by rules", "summaries and contents", "incremental state"],
    "stage1_not_done": ["meaning of pictures and drawings", "formulas", "order of columns on a page"],
    "deferred_contract": {t: dict(zip(("where", "source", "action"), _WORK[t])) for t in TYPES},
    "procedure": [
        "Take a document from stage2_pending: id, doc, source and its deferred items.",
        "Look up the type of an item in deferred_contract: where its markers stand, what to open, what to do.",
        "Open the file at doc and find the markers of the type by marker_pattern; there is one for each place.",
        "Do the work at each place and put the result where the marker stands. Markers with a unit may share one result for that unit: the first holds it, the others refer to it.",
        "When no marker of the type is left, take the item out in all four places: the body, the front matter's deferred, the document's deferred in catalog.yaml, stage2_pending.",
        "What cannot be done keeps its marker and its item, and gets a blocked entry; go on with the rest until only such items are left.",
    ],
    "marker_format": "<!-- stage2:type=count [unit=U] [class=C] note -->",
    "marker_pattern": MARKER,
    "marker_fields": {"count": "things left at this place", "unit": "page, slide or para: what the things have in common; absent where each stands alone", "class": "diagram, chart, photo, screenshot or formula, where that is known", "note": "free text"},
    "loc_field": {"pN": "page N", "slide:N": "slide N", "sheet:NAME": "sheet NAME", "absent": "the marker itself stands at the place"},
    "termination": {"done": "stage2_pending is empty", "blocked": "only blocked items are left; they stay listed for a person to look at", "idempotent": "a marker that was replaced is found no more, so a second round does no harm"},
    "blocked_format": {"blocked": {"reason": "why it cannot be done", "toolNeeded": "what would make it possible, or null", "retryable": "whether that is enough to try again without a person"}},
    "output_guide": {"docs/<category>/<doc-id>.md": "markers replaced, deferred of the front matter shortened", "index/artifact/catalog.yaml": "deferred of the document shortened", "index/process/handoff.yaml": "the document taken out of stage2_pending when nothing is left", "original-doc/": "never changed"},
    "layout": {"catalog": "index/artifact/catalog.yaml", "handoff": "index/process/handoff.yaml", "manifest": "index/process/.manifest.yaml", "docs": "docs/<category>/<doc-id>.md", "originals": "original-doc/<relpath>", "assets": "original-doc/<doc-id>_assets/"},
}
