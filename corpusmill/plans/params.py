"""Parameters of the operators with their defaults (fixed values where results depend on them)."""

SHINGLE = 5
#: Near-duplicates: Jaccard similarity from which two texts are linked; MinHash rows and bands.
SIMILARITY = 0.8
PERMUTATIONS, BANDS, SEED = 128, 16, 1
#: Containment: reported above the first, dropped above the second; least shingles of a container.
PARTIAL, DROP, CONTAINER_SHINGLES = 0.80, 0.95, 3000
IDENTITY = 0.5
LANGUAGE_FLOOR, YEAR_CEILING = 0.05, 0.05
INDEX_TITLES, INDEX_DIGITS, INDEX_TITLE_FLOOR, INDEX_LINES, TITLE_LENGTH = 0.65, 0.10, 0.30, 10, 60
MATTR_WINDOW = 500
LINE_FLOOR, MIN_ALPHA, NOISE_MOST, MIN_CHARS, HEADER_ZONE, ORPHAN_ZONE = 0.85, 0.84, 10, 400, 10, 30
TOKEN_BUDGET, PACK_BUFFER = 2048, 1000
HOLDOUT_CHARS, HOLDOUT_REJECT, HOLDOUT_SHARE, HOLDOUT_WORKS = (3000, 45000), 0.5, 0.05, 8
DEPTHS, BATCHES = (4, 6, 8), (16, 32)

#: Slovene function words by which running Slovene text is told (fixed values).
FUNCTION_WORDS = (
    "je in se da na ne so pa bi ni sem po ki za bil ga še ali kakor mu tudi to tako ko si mi bilo kaj od že iz vse bila ti če jo pri ter me jaz bo kako kar "
    "ta do le jih ker zdaj pred te več sta ji bili bo bodo med nad pod kjer ves vsa ima imajo saj kot vendar zato kadar nič kdo"
)
#: Characters of Slovene text; others count as unknown (fixed values, written as a character class).
ALLOWED = r"A-Za-zčšžćđČŠŽĆĐáàâäéèêëíìîïóòôöúùûüýőűÁÀÂÄÉÈÊËÍÌÎÏÓÒÔÖÚÙÛÜ0-9 \t\n\r.,;:!?\-–—…\"'»«„“”()\[\]/*"
#: Headings after which an article's apparatus begins (fixed values).
APPARATUS_PATTERN = "viri|sklici|opombe|reference|zunanje povezave|glej tudi|literatura|nadaljnje branje|sorodne strani|opombe in sklici"
#: Elements that only render something (fixed values).
RENDERED = ("score", "hiero", "chem", "mapframe", "maplink", "syntaxhighlight", "source", "imagemap", "gallery", "timeline", "math", "templatestyles")
#: Namespaces of media links, and names of special tokens (fixed values).
MEDIA_NAMESPACES = ("slika", "datoteka", "file", "image", "berilo")
SPECIAL_TOKENS = ("<|bos|>", "<|user_start|>", "<|user_end|>", "<|assistant_start|>", "<|assistant_end|>", "<|python_start|>", "<|python_end|>", "<|output_start|>", "<|output_end|>")
#: Pre-token pattern with digits in pairs, for byte-pair encoders of that family (fixed value).
SPLIT_PATTERN = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
