"""Column functions that turn the free text of a raw result row into attributes, and merge what a file and its folder say."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import parsing as ps

#: Emoji that mark the number of seeders and the name of an indexer (fixed values).
SEEDER_MARKS = "👥👤"
INDEXER_MARKS = ("🌐", "⚙️", "🔗", "🔎", "🔍", "☁️")
#: Ranges of signs that are shown as emoji, for a regex engine that has no property for them.
_EMOJI = r"\x{231A}-\x{231B}\x{23E9}-\x{23F3}\x{25FD}-\x{25FE}\x{2614}-\x{2615}\x{2648}-\x{2653}\x{267F}\x{2693}\x{26A1}\x{26AA}-\x{26AB}\x{26BD}-\x{26BE}\x{26C4}-\x{26C5}\x{26CE}\x{26D4}\x{26EA}\x{26F2}-\x{26F5}\x{26FA}\x{26FD}\x{2705}\x{270A}-\x{270B}\x{2728}\x{274C}\x{274E}\x{2753}-\x{2757}\x{2795}-\x{2797}\x{27B0}\x{27BF}\x{2B1B}-\x{2B1C}\x{2B50}\x{2B55}\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F1E6}-\x{1F1FF}\x{1F201}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F7E0}-\x{1F7EB}\x{1F90C}-\x{1F9FF}\x{1FA70}-\x{1FAFF}"
#: Country codes of flags and the language that each stands for (fixed values).
FLAG_LANGUAGES = {
    "GB": "English", "US": "English", "JP": "Japanese", "CN": "Chinese", "RU": "Russian", "SA": "Arabic", "PT": "Portuguese", "BR": "Portuguese", "ES": "Spanish", "FR": "French",
    "DE": "German", "IT": "Italian", "KR": "Korean", "IN": "Hindi", "TH": "Thai", "VN": "Vietnamese", "ID": "Indonesian", "TR": "Turkish", "IL": "Hebrew", "IR": "Persian",
    "UA": "Ukrainian", "GR": "Greek", "LT": "Lithuanian", "LV": "Latvian", "EE": "Estonian", "PL": "Polish", "CZ": "Czech", "SK": "Slovak", "HU": "Hungarian", "RO": "Romanian",
    "BG": "Bulgarian", "RS": "Serbian", "HR": "Croatian", "SI": "Slovenian", "NL": "Dutch", "DK": "Danish", "FI": "Finnish", "SE": "Swedish", "NO": "Norwegian", "MY": "Malay", "MX": "Latino",
}
#: Words of a name that say its languages, in the order of the results (fixed values): label, pattern of the token.
LANGUAGE_TOKENS = (
    ("Multi", "multi"), ("Dual Audio", "dual[ ._-]?(?:audio|lang(?:uage)?|flac|ac3|aac2?)"), ("Dubbed", "dub(?:s|bed|bing)?"), ("English", "english|eng"), ("Japanese", "japanese|jap|jpn"),
    ("Chinese", "chinese|chi"), ("Russian", "russian|rus"), ("Arabic", "arabic|ara"), ("Portuguese", "portuguese"), ("Spanish", "spanish|spa|esp"),
    ("French", "french|fra|fr|vf|vff|vfi|vf2|vfq|truefrench"), ("German", "deu(?:tsch)?(?:land)?|ger(?:man)?"), ("Italian", "italian|ita"), ("Korean", "korean|kor"), ("Hindi", "hindi|hin"),
    ("Bengali", "bengali|ben(?![ ._-]?the[ ._-]?men)"), ("Punjabi", "punjabi|pan"), ("Marathi", "marathi|mar"), ("Gujarati", "gujarati|guj"), ("Tamil", "tamil|tam"), ("Telugu", "telugu|tel"),
    ("Kannada", "kannada|kan"), ("Malayalam", "malayalam|mal"), ("Thai", "thai|tha"), ("Vietnamese", "vietnamese|vie"), ("Indonesian", "indonesian|ind"), ("Turkish", "turkish|tur"),
    ("Hebrew", "hebrew|heb"), ("Persian", "persian|per"), ("Ukrainian", "ukrainian|ukr"), ("Greek", "greek|ell"), ("Lithuanian", "lithuanian|lit"), ("Latvian", "latvian|lav"),
    ("Estonian", "estonian|est"), ("Polish", "polish|pol"), ("Czech", "czech|cze"), ("Slovak", "slovak|slo"), ("Hungarian", "hungarian|hun"), ("Romanian", "romanian|rum"),
    ("Bulgarian", "bulgarian|bul"), ("Serbian", "serbian|srp"), ("Croatian", "croatian|hrv"), ("Slovenian", "slovenian|slv"), ("Dutch", "dutch|dut"), ("Danish", "danish|dan"),
    ("Finnish", "finnish|fin"), ("Swedish", "swedish|swe"), ("Norwegian", "norwegian|nor"), ("Malay", "malay"), ("Latino", "latino|lat"),
)


def name_languages(name: Column) -> Column:
    """Languages that a name says, unless the word speaks of subtitles."""
    return ps.all_tokens(name, [(label, f"(?:{p})(?![ ._-]?sub(?:title)?s?)") for label, p in LANGUAGE_TOKENS])


def _flag(code: str) -> str:
    return "".join(chr(0x1F1E6 + ord(c) - ord("A")) for c in code)


def flag_languages(*texts: Column) -> Column:
    """Languages of the flags in each text in turn, each flag of a text once; a flag of no known language says nothing."""
    known = F.create_map(*[F.lit(x) for code, language in FLAG_LANGUAGES.items() for x in (_flag(code), language)])
    flags = [F.array_distinct(F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(r"([\x{1F1E6}-\x{1F1FF}]{2})"), F.lit(1))) for t in texts]
    return F.filter(F.transform(F.concat(*flags), lambda f: known[f]), lambda x: x.isNotNull())


def file_name(hint: Column, description: Column) -> Column:
    """The hinted name; else the first of five lines with a year, season or episode; else the first line.

    A found line loses blanks around it, emoji before it and a leading word with a colon.
    """
    lines = F.slice(F.filter(F.split(description, "\n"), lambda x: F.trim(x) != ""), F.lit(1), F.lit(5))
    numbered = rf"{ps.token(r's[0-9]{1,2}(?:[ ._-]?e[0-9]{1,4})?|[0-9]{1,2}x[0-9]{2,3}')}|(?<![0-9])(?:19|20)[0-9]{{2}}(?![0-9])"
    line = F.coalesce(F.try_element_at(F.filter(lines, lambda x: x.rlike(numbered)), F.lit(1)), F.try_element_at(F.split(description, "\n"), F.lit(1)))
    found = F.regexp_replace(F.regexp_replace(F.regexp_replace(line, r"^\s+|\s+$", ""), f"^[{_EMOJI}]+", ""), r"^[^\s:]+:\s*", "")
    return F.coalesce(F.nullif(hint, F.lit("")), found)


def marked_seeders(description: Column) -> Column:
    """The number behind the first mark of seeders."""
    return F.nullif(F.regexp_extract(description, rf"[{SEEDER_MARKS}]\s*(\d+)", 1), F.lit("")).cast("int")


#: A run of signs that are neither emoji nor line feeds, without the ending of the text's last line. All emoji come behind
#: U+2319, so the long list is asked only for signs behind it.
_PLAIN = rf"(?:[\x00-\x09\x0B\x0C\x0E-\x84\x86-\x{{2027}}\x{{202A}}-\x{{2319}}]++|\r(?!\n?\z)|[\x85\x{{2028}}\x{{2029}}](?!\z)|[\x{{231A}}-\x{{10FFFF}}&&[^{_EMOJI}]]++)*+"


def text_behind(description: Column, marks: Sequence[str]) -> Column:
    """The text behind the first of the marks, up to the next emoji or the end of the line; null without a mark."""
    mark = rf"(?:{'|'.join(marks)})"
    return F.when(description.rlike(mark), F.trim(F.regexp_extract(description, rf"{mark}\s*({_PLAIN})", 1)))


def marked_indexer(description: Column) -> Column:
    """The name of an indexer, behind its mark."""
    return text_behind(description, INDEXER_MARKS)


def fallback(*arrays: Column) -> Column:
    """The first array that holds anything, or null."""
    return F.coalesce(*[F.when(F.coalesce(F.size(a), F.lit(0)) > 0, a) for a in arrays])


def merged(*arrays: Column) -> Column:
    """Elements of all arrays in order, each once; a null array is empty."""
    return F.array_distinct(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays]))


#: Letters that end a name like a file's, with a dot before them or not (fixed values).
NAME_ENDINGS = "mkv mp4 avi mov wmv flv webm m4v mpg mpeg 3gp 3g2 m2ts ts vob ogv ogm divx xvid rm rmvb asf mxf mka mks mk3d f4v f4p f4a f4b"


def folder_name(folder: Column, name: Column) -> Column:
    """The folder, unless it says the same as the file, whatever their endings."""
    plain = lambda x: F.lower(F.regexp_replace(F.regexp_replace(x, rf"(?i)(?=\w{{2,4}}$)(?:{NAME_ENDINGS.replace(' ', '|')})$", ""), r"[^\p{L}\p{N}+]+", ""))
    return F.when(~F.coalesce((folder != "") & (name != "") & (plain(folder) == plain(name)), F.lit(False)), folder)


def folder_size(folder: Column, size: Column) -> Column:
    """The folder's size, unless it is within a twentieth of the file's."""
    return F.when(~F.coalesce((size > 0) & (F.abs(size - folder) / size < 0.05), F.lit(False)), folder)


def is_season_pack(parsed: Column, episodes: Column, size: Column, folder: Column) -> Column:
    """Named as a pack; or episodes stand and the folder is more than twice the file; or more than five episodes stand."""
    n = F.coalesce(F.size(episodes), F.lit(0))
    return F.coalesce(parsed, F.lit(False)) | ((n > 0) & F.coalesce(folder > 2 * size, F.lit(False))) | (n > 5)


def wrong_season(seasons: Column, episodes: Column, season: Column, absolute: Column) -> Column:
    """Seasons stand and the asked one is not among them; season 1 alone passes where the absolute episode is named."""
    stands = F.coalesce(F.size(seasons), F.lit(0)) > 0
    numbered = (F.size(seasons) == 1) & (F.try_element_at(seasons, F.lit(1)) == 1) & F.coalesce(F.array_contains(episodes, absolute), F.lit(False))
    return F.coalesce(stands & season.isNotNull() & ~F.array_contains(seasons, season) & ~numbered, F.lit(False))


def wrong_episode(episodes: Column, asked: Column, others: Sequence[Column] = ()) -> Column:
    """Episodes stand, and neither the asked one nor another number of it is among them."""
    stands = F.coalesce(F.size(episodes), F.lit(0)) > 0
    named = F.coalesce(F.array_contains(episodes, asked), F.lit(False))
    for other in others:
        named = named | F.coalesce(F.array_contains(episodes, other), F.lit(False))
    return stands & asked.isNotNull() & ~named


#: Endings of videos, and of files that are none (fixed values).
VIDEO_ENDINGS = "3g2 3gp amv asf avi drc f4a f4b f4p f4v flv gif gifv iso m2v m4p m4v mkv mov mp2 mp4 mpg mpeg mpv mng mpe mxf nsv ogg ogv qt rm rmvb roq svi webm wmv yuv m3u8 m2ts"
OTHER_ENDINGS = (
    "txt jpg jpeg png gif bmp svg webp nfo sfv srt ass sub idx cue log doc docx xls xlsx ppt pptx pdf rtf odt ods odp csv tsv exe bat apk dll"
    " zip rar 7z tar gz bz2 xz md json xml ini dat db dbf bak"
)


def _ends(name: Column, endings: str, more: str = "") -> Column:
    return F.coalesce(name.rlike(rf"\.(?:{endings.replace(' ', '|')}{more})$"), F.lit(False))


def is_video(name: Column, mime: Column) -> Column:
    """Whether the type says video or the name ends like one; case counts."""
    return F.coalesce(mime.contains("video"), F.lit(False)) | _ends(name, VIDEO_ENDINGS)


def is_not_video(name: Column, mime: Column) -> Column:
    """Whether a known type is no video, or the name ends like another file or a numbered archive part; both may hold for one file."""
    return F.coalesce((mime != "") & ~mime.contains("video"), F.lit(False)) | _ends(name, OTHER_ENDINGS, r"|7z\.\d+")
