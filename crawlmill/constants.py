"""Fixed values.

Everything in this module is data that results depend on (patterns, word lists,
code tables, defaults). They are stated once, here, and used elsewhere
by name.
"""

from __future__ import annotations

# --- URL handling ---------------------------------------------------------------
HTTP_SCHEMES = ("http", "https")
# "/index.html", "/index.htm", "/index.php" anywhere in a path become "/".
INDEX_PAGE = r"/index\.(html|htm|php)"

# --- link classification --------------------------------------------------------
# A bare e-mail address; (?U) makes \w cover Unicode letters.
BARE_EMAIL = r"(?U)^[\w\.\+\-]+\@[\w]+\.[a-z]{2,3}$"
# Video files are ignored.
IGNORED_URL = r"\.(mp4|MP4|avi|AVI)$"
# Documents that are stored as binary data.
DOCUMENT_URL = r"\.(pdf|PDF|doc|DOC|ppt|PPT)(x|X)?\/?$"
# The last purely alphabetic extension of a URL.
URL_EXTENSION = r"\.([a-zA-Z]*)$"
# Extensions (lower-cased) that are neither pages nor stored documents.
DROPPED_EXTENSIONS = (
    "pdf", "ppt", "pptx", "potx", "pps", "ppsx", "ps", "zip", "img", "jpg", "jpeg",
    "png", "exe", "tar", "doc", "docx", "xls", "xlsx", "csv", "txt", "dat",
)
# Script assignment that navigates to a new page.
ONCLICK_ASSIGNMENT = r"((document|window|parent).)?location(.href)?="
# Image sources that count as images.
IMAGE_URL = r"\.(png|PNG|img|IMG|jp(e)?g|JP(E)?G)$"
# Image types that are stored.
STORED_IMAGE_TYPES = ("img", "png", "jpg")

# --- robots ---------------------------------------------------------------------
SITEMAP_DIRECTIVE = r"Sitemap: ([^\n]*)"
DEFAULT_CRAWL_DELAY = 4  # seconds

# --- code tables ----------------------------------------------------------------
PAGE_TYPES = ("HTML", "BINARY", "DUPLICATE", "FRONTIER", "FORBIDDEN")
DATA_TYPES = ("PDF", "DOC", "DOCX", "PPT", "PPTX")

# --- crawl configuration defaults -----------------------------------------------
ERROR_STATUS = 400  # this status and above is an error
