"""Personal information in free text: found by labelers that vote, replaced by typed placeholders.

Wide patterns propose spans. Labelers (form checks, gazetteers and general cues around a span: labels,
forms of address, roles, verbs of contact, units) vote yes, no or abstain on each.
Expectation-maximisation over the counts of all vote patterns of the whole corpus estimates each
labeler's reliability and a probability per pattern. These soft labels train a final logistic span
classifier, which also sees the words around a span, on a bounded sample (``SAMPLE_SPANS``); it
scores every span of every text. Of overlapping spans the surer kind stays.

A text is read sentence by sentence; a worker remembers the latest ``REMEMBERED`` sentences, since
boilerplate repeats. Spans are code points of the text as stored: patterns run over a normalised copy
(composed letters, narrow digits) whose characters are mapped back.

Defined results: null, empty and blank texts have no span and come out as they are; placeholders that
are there already are left alone; rows with the same id and text have their spans once; texts of any
length are read whole; an empty table gives no span.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.session import checkpointed

TYPES = ["EMAIL", "ID_NUMBER", "PHONE", "ADDRESS", "NAME"]
SAMPLE_SPANS = 40_000
BUCKETS = 16_384
REMEMBERED = 20_000
SILENCE = 0.25  # what an abstention counts beside a vote, for our labelers, whose cues stand for one another

# Gazetteers, lower case and without accents. Family names, given names, words that are
# no part of a person's name, places, words that begin sentences.
SURNAMES = set("""nguyen tran le pham hoang huynh phan vu vo dang bui do ho ngo duong ly doan khong au tu thach luong mai dinh trinh dao truong lam ha cao
chau ta to quach kieu tang la vuong luu ton thai khuat nghiem phung mac tong giang an lai lo kim chu quan bach dam ninh
smith johnson williams brown jones miller davis wilson anderson taylor thomas moore martin lee thompson white harris clark lewis walker hall allen young king
wright scott green baker adams nelson carter mitchell roberts turner phillips campbell parker evans edwards collins murphy kelly wong chen wang li zhang singh
patel kumar garcia rodriguez martinez lopez mueller muller schmidt schneider fischer weber meyer wagner becker schulz hoffmann koch richter klein wolf schroder
dubois durand moreau laurent simon michel lefebvre leroy roux girard bonnet fournier tanaka suzuki sato yamamoto watanabe ito kobayashi""".split())
GIVEN_NAMES = set("""james john robert michael william david richard joseph thomas charles daniel matthew anthony mark paul steven andrew kevin brian george edward
peter adam eric stephen jack tom tim sam ben alex chris nick mary patricia jennifer linda elizabeth barbara susan jessica sarah karen lisa nancy sandra ashley emily
emma olivia anna julia laura maria rachel hannah kate amy jane claire sophie marie pierre jean jacques philippe nicolas luc camille julie isabelle hans klaus
jurgen stefan andreas markus thomas lukas felix sabine petra monika heike katrin ute birgit priya ravi anil sanjay mei hiroshi kenji yuki
van thi anh minh hung dung huong lan hoa linh nga thuy trang tuan quang duc khanh long nam phuong quynh thao ngoc thanh bao binh chi cuong dat giang
hai hanh hien hieu khoa kien loan nhung oanh phuc son tam thang thu trung tung uyen vinh yen""".split())
THINGS = set("""engineer engineering developer analyst scientist manager architect designer tester master owner administrator consultant specialist writer officer director
intern fresher junior senior lead head team group company jsc tnhh ltd inc corp llc co gmbh bank university school viet vietnam nam tphcm hcm hn qa hr it cv
java python javascript typescript spring boot react native angular vue node next docker kubernetes terraform ansible jenkins linux amazon web services microsoft azure
google cloud platform apache spark kafka airflow hadoop snowflake power bi tableau oracle database sql mysql mongodb redis php ruby scala kotlin swift rust go flutter
site reliability quality assurance machine learning technical support project product business data backend frontend fullstack mobile security network system
monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december
english japanese korean german french su id citizen passport cccd cmnd cmt ssn hotline zalo tel phone email mail fax road street avenue drive lane boulevard ward district phuong quan""".split())
PLACES = {"ha noi", "ho chi minh", "da nang", "can tho", "hai phong", "binh duong", "dong nai", "bac ninh", "hung yen", "quang ninh", "khanh hoa", "lam dong",
          "thua thien hue", "nghe an", "thanh hoa", "vinh phuc", "hai duong", "thai nguyen", "long an", "ba ria", "vung tau", "binh dinh", "quang nam", "gia lai",
          "dak lak", "kien giang", "tay ninh", "nam dinh", "phu tho", "sai gon", "nha trang", "da lat", "quy nhon", "viet nam", "singapore", "tokyo", "new york", "london", "berlin", "paris"}
SENTENCE_STARTS = set("""as contact ask call text with hi hello dear thanks thank the best kind regards please apply follow visit while when after before by and or but this that
if you we in on at for from our your write meet reach email mail tel cv hr your new our all sincerely cheers signed manager recruiter mentor supervisor
gap goi cam lien ho nguoi mentor truong khi voi trong moi ngoai cung doi tai theo va tu den da sap gui nop phong dia so ban toi chung cong chao kinh nho hoi xin
bitte fragen kontaktieren rufen senden der die das den dem ein eine sie ihnen wir uns la le les nous vous il elle herzliche liebe lieber hallo mit bei von unser unsere ihr ihre contactez appelez ecrivez bonjour merci cher chere avec notre votre pour madame""".split())
#: Sentence starts that are names as well.
NAMES_TOO = set("truong ho lien dia so to tu ban sap hi don mai".split())
_NO_NAME = SENTENCE_STARTS - NAMES_TOO

_PLACE = re.compile("|".join(sorted(PLACES, key=len, reverse=True)))

_CAP = "".join(c for c in map(chr, [*range(0x41, 0x5B), *range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if unicodedata.category(c) == "Lu")
_LAT = r"A-Za-zÀ-ɏḀ-ỿ"
_W = rf"[{_CAP}][{_LAT}'’]*"
_WS = rf"{_W}(?:[ ]+{_W})*"
_NO = r"\d{1,4}(?:/\d{1,4})*[A-Za-z]?"
_LANE = r"(?i:hẻm|ngõ|ngách|kiệt|hem|ngo|ngach|kiet)"
_ROAD = r"(?i:đường|phố|đại lộ|duong|pho|dai lo)"
_ADMIN = rf"(?:(?:P|Q|TP|TX|H|X)\.\s?(?:\d+|{_WS})|(?i:phường|quận|xã|huyện|thị trấn|thị xã|thành phố|tỉnh|phuong|quan|xa|huyen|thi tran|thi xa|thanh pho|tinh|Ward|District|Dist\.)[ ]+(?:\d+|{_WS}))"
_TAIL = rf"(?:[ ]*,[ ]*(?:{_ADMIN}|{_WS}))*"
_EN = r"(?:Road|Rd\.?|Street|St\.?|Avenue|Ave\.?|Boulevard|Blvd\.?|Drive|Dr\.?|Lane|Ln\.?|Way|Court|Place|Square|Quay|Terrace|Crescent|Parkway|Pkwy\.?|Highway|Hwy\.?|Close|Row|Walk|Plaza)"
_FR = r"(?i:rue|avenue|av\.|boulevard|bd|place|quai|allée|chemin|impasse|cours)"
_POST = rf"\d{{4,5}}[ ]{_W}(?:[ ]{_W})?"  # postal code and town
_STREET_NAME = r"(?i:straße|strasse|str\.|weg|gasse|allee|platz|ring|damm|ufer|hang|steig|hof)\s\d"
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*\s?(?:@|[(\[{]\s?(?:at|AT)\s?[)\]}])\s?[A-Za-z0-9\-]+(?:(?:\.|\s?[(\[{]\s?(?:dot|DOT)\s?[)\]}]\s?)[A-Za-z0-9\-]+)+")
PHONE = re.compile(r"(?<![A-Za-z0-9_+#@])(?<!\d[.,/\-:])(?:\(\+?\d{1,4}\)|\+?\d)(?:[ .\-]?(?:\(\d{1,4}\)|\d))+(?![A-Za-z0-9_])")
ID = re.compile(r"(?<![A-Za-z0-9_\-.#/+])(?:[A-Z][ ]?\d{7,8}|\d{3}[ \-]\d{2}[ \-]\d{4}|\d{4}([ .\-])\d{4}\1\d{4}|\d{3}[ .\-]?\d{3}[ .\-]?\d{3}(?:[ .\-]?\d{3})?)(?![A-Za-z0-9_\-/]|[.,]\d)")
ADDRESSES = [re.compile(p) for p in (
    rf"(?<![\w/.,\-]){_NO},?[ ]+(?:{_LANE}[ ]+[\d/]+[A-Za-z]?,?[ ]+)*{_ROAD}[ ]+{_WS}{_TAIL}",
    rf"(?<!\w){_LANE}[ ]+[\d/]+[A-Za-z]?,?[ ]+(?:{_ROAD}[ ]+)?{_WS}{_TAIL}",
    rf"(?<![\w/.,\-])\d{{1,4}}(?:/\d{{1,4}}[A-Za-z]?)+,?[ ]+{_WS}{_TAIL}",
    rf"(?<![\w/.,\-]){_NO}[ ]+{_WS}[ ]*,[ ]*{_ADMIN}{_TAIL}",
    rf"(?<![\w/.,\-]){_NO}[ ]+{_WS}(?:[ ]*,[ ]*{_WS}){{2,}}",
    rf"(?<![\w/.,\-])\d{{1,5}}[A-Za-z]?[ ]+{_W}(?:[ ]+{_W}){{0,3}}?\s{_EN}(?!\w){_TAIL}",
    rf"(?<!\w){_ROAD}[ ]+{_WS}[ ]*,[ ]*(?:số[ ]+\d+|{_ADMIN}){_TAIL}",
    rf"(?<![\w/.,\-])(?:{_W}[ ]){{0,2}}{_W}[ ]\d{{1,4}}[a-z]?,[ ]?{_POST}",
    rf"(?<![\w/.,\-])\d{{1,4}}(?:[ ]?(?:bis|ter))?,?[ ]{_FR}[ ](?:(?:de|du|des|la|le|l'|d')[ ]?){{0,3}}{_WS}(?:[ ]*,[ ]*(?:{_POST}|{_WS}))*",
)]
#: What every one of them needs.
_HOUSE = re.compile(rf"\d[\d/]*[A-Za-z]?(?:[ ]?(?:bis|ter))?,?[ ]+(?:[{_CAP}]|{_LANE}|{_ROAD}|{_FR})|{_LANE}[ ]+\d|{_ROAD}[ ]+[{_CAP}]|[{_CAP}][{_LAT}'’]*[ ]\d{{1,4}}[a-z]?,")
_HONORIFIC = re.compile(r"^(?:Mr|Ms|Mrs|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Mlle|Anh|Chị|Ông|Bà|Cô|Chú|Thầy|Em)$")
CJK_NAME = re.compile(r"[一-鿿々]{1,3}[ 　][一-鿿々ぁ-ゖァ-ヺ]{1,4}?(?=さん|様|氏)|(?<![一-鿿々])[一-鿿々]{1,3}[ 　][一-鿿々ぁ-ゖァ-ヺ]{1,4}(?![一-鿿々ぁ-ゖァ-ヺ])|(?<![一-鿿々ぁ-ゖァ-ヺ])[一-鿿々]{2,6}(?![一-鿿々ぁ-ゖァ-ヺ])|[一-鿿々]{2,5}(?=さん|様|氏)")
_PART = rf"[{_CAP}](?:\.(?=\s?[{_CAP}])|[{_LAT}'’\-]*)"
NAME_RUN = re.compile(rf"(?<![{_LAT}0-9@#_/.\-]){_PART}(?:[  ]{{1,2}}(?:(?:van|von|der|den|de|la|du|dos|bin)[ ]){{0,2}}{_PART})*(?![{_LAT}0-9@_])")
_TURNED = re.compile(rf",[ ](?:[{_CAP}][{_LAT}'’]*\.?[ ]?){{1,2}}(?=[.,;:<\n]|\s|$)")
_TOKEN, _SPACE = re.compile(r"\S+"), re.compile(r"\s")
_NO_DIGIT, _LETTERS, _DIGITS, _REPEATED = re.compile(r"\D"), re.compile(r"[^\W\d_]"), re.compile(r"\d"), re.compile(r"(.)\1+")
_AROUND = re.compile(r"[^\W\d]+|\d+|[^\w\s]")
_AT = re.compile(r"@|[(\[{]\s?(?:at|AT)\s?[)\]}]")
_DIGIT = re.compile(r"\d")
_CJK = re.compile(r"[一-鿿々]")

_MARKS = "".join(re.escape(chr(c)) for c in range(0x300, 0x10000) if unicodedata.combining(chr(c)))
_PIECE = re.compile(rf"[\x00-\x7f]+(?![{_MARKS}])|.[{_MARKS}]*", re.S)


def normal(text: str) -> tuple[str, list[int] | None]:
    """A composed, narrow copy, and the code point of ``text`` that each of its characters comes from (None: the same)."""
    if unicodedata.is_normalized("NFKC", text):
        return text, None
    out, at = [], []
    for m in _PIECE.finditer(text):
        piece = m.group()
        if piece.isascii():
            at += range(m.start(), m.end())
        else:
            piece = unicodedata.normalize("NFKC", piece)
            at += [m.start()] * len(piece)
        out.append(piece)
    return "".join(out), [*at, len(text)]


class _Bases(dict):
    """Every character's lower-case letter without accents: one for one, so that places stay."""

    def __missing__(self, code: int) -> str:
        bare = [c for c in unicodedata.normalize("NFD", chr(code).lower()) if unicodedata.category(c) != "Mn"]
        self[code] = base = {"đ": "d", "ß": "s"}.get(bare[0], bare[0]) if bare else " "
        return base


_BASES = _Bases()


def plain(text: str) -> str:
    return text.translate(_BASES)


_SENTENCE_END = re.compile(rf"[\r\n  \x85\v\f<>]+|[.!?…][\"'”’)\]]?\s+(?=[\"'“‘(\[]?[{_CAP}\d+一-鿿ぁ-ヿ])|[。！？]")
_SHORT = re.compile(r"(?:^|[\W\d_])(?:[^\W\d_]|(?-i:Mr|Mrs|Ms|Dr|Prof|Mme|Mlle)|st|rd|ave|blvd|ln|no|nr|tel|str|tp|tx|inc|ltd|co|jr|sr|ext)\.$", re.I)


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Where the sentences and lines of a text begin and end; no end after a short form or initial."""
    a = 0
    for m in _SENTENCE_END.finditer(text):
        end, mark = m.start(), text[m.start()]
        if mark in ".!?…。！？":
            end += 1
            if mark == "." and _SHORT.search(text[max(a, end - 8):end]):
                continue
        if end > a:
            yield a, end
        a = m.end()
    if a < len(text):
        yield a, len(text)


# General cues, matched against lower-case letters without accents.
_ROLE = (r"(?:manager|recruiter|mentor|lead(?:er)?|head|director|c[etfo]o|officer|supervisor|colleague|contact(?: person)?|interviewer|coordinator|coach|founder|author|engineer|developer|name|holder|host|trainer|"
         r"teacher|instructor|assistant|hr|nguoi(?: \w+){1,2}|phu trach|truong (?:nhom|phong|bo phan)|quan ly|giam doc|nhan vien|dong nghiep|tro ly|giang vien|huong dan|mentor cua ban|ho (?:va )?ten|ten|dau moi|"
         r"ansprechpartner(?:in)?|leiter(?:in)?|kolleg(?:e|in)|chef(?:in)?|responsable|directeur|directrice|collegue|nom|recruteu(?:r|se)|担当者?|氏名|名前)")
_A_ROLE = re.compile(_ROLE)
_ROLE_BEFORE = re.compile(rf"(?:\b|(?<=[一-鿿])){_ROLE}(?: (?:is|are|was|will be|la|se la|ist|est|sera|wird|heisst|s'appelle|cua ban))?\s*[:：,\-–]?\s*$")
_VERB_BEFORE = re.compile(r"\b(?:contact|call|ask(?: for)?|e-?mail|write(?: to)?|meet(?: with)?|reach(?: out to)?|message|by|dear|hi|hello|thanks?|regards|sincerely|cheers|signed|as|lien he|gap|goi|gui(?: cho)?|nho|hoi|cam on|chao|kinh gui|boi|do|tran trong|than|"
                          r"fragen sie|kontaktieren sie|sie|gru(?:ss|s)en?|lieber?|hallo|von|an|contactez|joindre|appelez|chere?|bonjour|merci|cordialement|par|avec)\s*[,:]?\s*$")
#: A form of address; matched against the text itself, since without accents "có" (has) is "cô".
_PERSON = re.compile(r"(?<![^\W\d_])(?:(?:Mr|Ms|Mrs|Miss|Dr|Prof|Herrn?|Frau|Monsieur|Madame|Mme|Mlle)\.?|(?i:anh|chị|ông|bà|cô|chú|thầy|chi|ong|ba|chu|thay))\s*$")
_PERSON_AFTER = re.compile(r"^\s?,?\s?(?:(?:will|would|said|says|told|wrote|writes|leads?|led|manages?|runs?|joined|moved|left|started|works|worked|interviews?|handles?|answers?|helps?|put|thinks?|"
                           r"se|da|dang|phu trach|phong van|chia se|huong dan|ho tro|tra loi|duyet|leitet|wird|hat|arbeitet|vous|dirige|sera|repond|travaille)\b|さん|様|氏)")
_CONTACT_AFTER = re.compile(r"^\W{0,4}(?:(?:tel|phone|dt|sdt|e-?mail|mail|hotline|zalo|mobile|at|on|qua|so|via|under|unter|au|am)\b\W{0,3}){0,2}(?:[+(]?\d[\d .()\-]{6,}|[\w.+\-]+\s?(?:@|[(\[]\s?at\s?[)\]]))" rf"|^\s?[(,\-–]\s?{_ROLE}\b")
_THING_BEFORE = re.compile(r"(?:\b(?:cong ty|tap doan|tnhh|co phan|company|group|firma|bei|societe|chez|tai|in|at|o|on|using|dung|bang|tren|ve|about|our|vi tri|cum|tac vu|san pham|product|project|the|an?|duong|pho|phuong|quan|xa|ward|district)|/|\d,?|[をのはやとで])\s*$")
_THING_AFTER = re.compile(r"^\s?(?:(?:jsc|group|co|ltd|inc|corp|gmbh|ag|viet nam|team|cluster|platform|project|product|version|certificate|stack|engineer|developer|street|road)\b|,? ltd|[をにへで])")
_PHONE_WORDS = re.compile(r"(?:\b(?:hotline|zalo|whatsapp|viber|telegram|tel|telephone|telefon|phone|mobile|cell|handy|fax|call|ring|text|sms|reach|dial|number|dt|sdt|dien thoai|di dong|(?<!ma )so|goi|nhan tin|lien he|lien lac|dau moi|rufnummer|anrufen|nummer|portable|appelez|numero|joindre|au)\b|電話|携帯)[^.!?]{0,22}$")
_HOURS_AFTER = re.compile(r"^[^.!?]{0,24}\b(?:\d{1,2}[:h]\d{2}|gio hanh chinh|business hours|office hours)")
_CODE_WORDS = re.compile(r"(?:\b(?:ma (?:so|tin|yeu cau|don|hang)|don hang|order|ticket|invoice|hoa don|doanh nghiep|mst|tax|budget|uptime|version|build|commit|image|sha|account|so tai khoan|stk|ref|no\. of|part|serial|sku|bestellung|rechnung|konto|commande|facture|compte)\b|注文)[^.!?]{0,14}$|order no\.\s*$")
_ID_WORDS = re.compile(r"(?:\b(?:cccd|cmnd|cmt|can cuoc|passport|ho chieu|ssn|social security|id (?:card|number|no)|(?:citizen|national) id|identity|chung minh|dinh danh|tuy than|reisepass\w*|ausweis\w*|personalausweis\w*|passeport|carte d'identite|cni)\b|パスポート|身分証)[^!?]{0,20}$")
_UNIT_AFTER = re.compile(r"^\s?(?:(?:vnd|usd|eur|dong|ms|kg|km|gb|mb|users?|people|rows|nguoi|nhan vien)\b|%|[€$₫]|- \d|–)")
_PLACE_WORDS = re.compile(r"(?:\b(?:at|tai|ve|o|dia chi|dia diem|nha|la|truc tiep|address|so|office|visit|from|to|in|adresse|anschrift|chez|au|den)\b\s*:?|:|住所)\s*$")
_NOT_A_HOUSE = re.compile(r"\b(?:tang|floor|phong|khu|room|block|in|khoang|hon|version|over|page|etage)\s*$")
_CONTACT = re.compile(r"@|\d{3}[ .\-]?\d{3}|さん|様|氏")


class Seen:
    """One proposed span in its sentence, with what is around it."""

    __slots__ = ("t", "a", "b", "span", "digits", "before", "after", "words", "things", "rest")

    def __init__(self, t: str, q: str, a: int, b: int, lead: str, things: frozenset[str]):
        self.t, self.a, self.b, self.span = t, a, b, t[a:b]
        self.digits = _NO_DIGIT.sub("", self.span)
        self.before, self.after = (lead + q[max(0, a - 60):a])[-60:], q[b:b + 40]
        self.words = [w.strip(".'’-,") for w in q[a:b].split()]
        self.things, self.rest = things, q[:a] + "\n" + q[b:]


def _yes(test) -> int:
    return 1 if test else 0


def _no(test) -> int:
    return -1 if test else 0


def _either(test) -> int:
    return 1 if test else -1


def _national(s: Seen) -> bool:
    """A number of a country's own form: Vietnam, North America, Germany, France, Japan; or with a country code."""
    bare = s.span.lstrip("(")
    local = re.sub(r"^(?:84|0084)(?=\d{9,10}$)", "0", s.digits)
    return bool(re.fullmatch(r"0[1-9]\d{8,9}", local) or (re.match(r"\+|00[1-9]", bare) and 9 <= len(s.digits) <= 14) or re.fullmatch(r"(?:1[ .\-])?\(?[2-9]\d{2}\)?[ .\-]\d{3}[ .\-]\d{4}", s.span) or re.fullmatch(r"0\d{1,4}[ \-/]\d{4,8}", s.span))


#: The labelers of each kind, by name.
LABELERS: dict[str, dict[str, Callable[[Seen], int]]] = {
    "EMAIL": {
        "top level domain": lambda s: _either(re.search(r"(?:\.|dot[)\]}]\s?)[A-Za-z]{2,}$", s.span)),
        "placeholder": lambda s: _no("[REDACTED" in s.span or s.span.endswith("@")),
        "contact words": lambda s: _yes(re.search(r"(?:cv|mail|ho so|apply|contact|gui|lien he|write|send|:|at|\()[^.]{0,25}$", s.before)),
        "digest or version": lambda s: _no(re.search(r"(?:sha\d*|v\d)", s.span.partition("@")[2])),
        "local part": lambda s: _either(re.match(r"[A-Za-z0-9._%+\-]{2,}", s.span)),
    },
    "PHONE": {
        "national form": lambda s: _either(_national(s)),
        "phone words": lambda s: _yes(_PHONE_WORDS.search(s.before)),
        "hours after": lambda s: _yes(_HOURS_AFTER.search(s.after)),
        "code words": lambda s: _no(_CODE_WORDS.search(s.before)),
        "identity words": lambda s: _no(_ID_WORDS.search(s.before)),
        "unit after": lambda s: _no(_UNIT_AFTER.search(s.after)),
        "first character": lambda s: _either(s.span[0] in "0+(") if not re.fullmatch(r"\(?[2-9]\d{2}\)?[ .\-]\d{3}[ .\-]\d{4}", s.span) else 0,
        "address of a host or amount": lambda s: _no(re.fullmatch(r"\d{1,3}(?:\.\d{1,3}){3}|\d{1,3}(?:\.000)+", s.span)),
        "in brackets after a word": lambda s: _yes(s.a and re.search(rf"[{_LAT}]\s?\($", s.t[max(0, s.a - 3):s.a])),
    },
    "ID_NUMBER": {
        "identity words": lambda s: _either(_ID_WORDS.search(s.before)),
        "social security form": lambda s: _yes(re.fullmatch(r"\d{3}-\d{2}-\d{4}", s.span)),
        "passport form": lambda s: _yes(re.fullmatch(r"[A-Z]\d{7}", s.span)),
        "citizen card form": lambda s: _yes(len(s.digits) == 12 and s.digits[0] == "0" and "-" not in s.span),
        "code words": lambda s: _no(_CODE_WORDS.search(s.before)),
        "unit after": lambda s: _no(_UNIT_AFTER.search(s.after)),
        "phone words": lambda s: _no(_PHONE_WORDS.search(s.before) and not _ID_WORDS.search(s.before)),
    },
    "ADDRESS": {
        "place words": lambda s: _yes(_PLACE_WORDS.search(s.before)),
        "district or postal code": lambda s: _yes(re.search(rf"{_ADMIN}|,[ ]?{_POST}", s.span)),
        "street word": lambda s: _yes(re.search(rf"{_ROAD}\s|{_LANE}\s|\s{_EN}(?!\w)|{_STREET_NAME}|\d,?\s{_FR}\s", s.span)),
        "house number": lambda s: _yes(re.match(r"\d", s.span)),
        "no house": lambda s: _no(_NOT_A_HOUSE.search(s.before)),
        "place": lambda s: _yes(_PLACE.search(plain(s.span))),
        "thing": lambda s: _no(sum(w in s.things for w in s.words) > 1),
    },
    "NAME": {
        "form of address": lambda s: _yes(_PERSON.search(s.t[max(0, s.a - 12):s.a])),
        "role before": lambda s: _yes(_ROLE_BEFORE.search(s.before)),
        "verb of contact before": lambda s: _yes(_VERB_BEFORE.search(s.before)),
        "verb of a person after": lambda s: _yes(_PERSON_AFTER.search(s.after)),
        "contact after": lambda s: _yes(_CONTACT_AFTER.search(s.after)),
        "family name": lambda s: _yes(len(s.words) > 1 and (s.words[0] in SURNAMES or s.words[-1] in SURNAMES)),
        "given name": lambda s: _yes(len(s.words) > 1 and (s.words[0] in GIVEN_NAMES or s.words[-1] in GIVEN_NAMES)),
        "thing": lambda s: _no(any(w in s.things for w in s.words)),
        "thing before": lambda s: _no(_THING_BEFORE.search(s.before)),
        "thing after": lambda s: _no(_THING_AFTER.search(s.after)),
        "place": lambda s: _no(_PLACE.search(" ".join(s.words))),
        "length or digits": lambda s: _no(len(s.words) > 4 or re.search(r"\d", s.span)),
        "initial": lambda s: _yes(re.match(rf"[{_CAP}]\.\s", s.span) or re.search(rf",\s[{_CAP}]\.$", s.span)),
        "contact in sentence": lambda s: _yes(_CONTACT.search(s.rest)),
    },
}


def _numbers(t: str) -> Iterator[tuple[int, int]]:
    """Runs of digits that may be phone numbers; runs of several are parted wherever two valid ones are left."""
    for m in PHONE.finditer(t):
        starts = [m.start()]
        if len(_NO_DIGIT.sub("", m.group())) > 14:
            for x in re.finditer(r"(?<=\d)[ \-](?=[0+(])", m.group()):
                at = m.start() + x.start()
                if sum(c.isdigit() for c in t[starts[-1]:at]) >= 9 and sum(c.isdigit() for c in t[at:m.end()]) >= 8:
                    starts.append(at + 1)
        for a, b in zip(starts, [*(x - 1 for x in starts[1:]), m.end()]):
            if 8 <= len(_NO_DIGIT.sub("", t[a:b])) <= 14:
                yield a, b


def _names(t: str, q: str, lead: str, things: frozenset[str]) -> Iterator[tuple[int, int]]:
    for m in NAME_RUN.finditer(t):
        if not _SPACE.search(m.group()) and not (_PERSON.search(t[max(0, m.start() - 12):m.start()]) or t.startswith(", ", m.end())):
            continue  # one word alone, which nothing says to be a name
        run = [(q[m.start() + x.start():m.start() + x.end()].rstrip("."), m.start() + x.start(), m.start() + x.end()) for x in _TOKEN.finditer(m.group())]
        titled = False
        for i, (_, a, b) in enumerate(run):
            if _HONORIFIC.match(t[a:b].rstrip(".")):
                run, titled = run[i + 1:], True
                break
        while len(run) > 1 and len(run[0][0]) > 1 and (run[0][0] in SENTENCE_STARTS or (len(run) > 2 and (run[0][0] in things or _A_ROLE.fullmatch(run[0][0])))) and run[0][0] not in SURNAMES:
            run = run[1:]
        while len(run) > 2 and (run[-1][0] in _NO_NAME or run[-1][0] in things) and run[-1][0] not in NAMES_TOO and run[-1][0] not in SURNAMES and run[-1][0] not in GIVEN_NAMES:
            run = run[:-1]
        if all(w in things or w in _NO_NAME or len(w) == 1 for w, _, _ in run) or _PLACE.fullmatch(" ".join(w for w, _, _ in run)):  # none of its words can be of a name
            continue
        if len(run) > 5:  # a name and what follows it: the votes tell which part
            for i in range(len(run) - 1):
                for last in run[i + 1:i + 5]:
                    if not ({run[i][0], last[0]} & (_NO_NAME | things)):
                        yield run[i][1], last[2]
            continue
        a, b = run[0][1], run[-1][2]
        before = (lead + q[max(0, a - 40):a])[-40:]
        led = titled or bool(_PERSON.search(t[max(0, a - 12):a]))
        if len(run) == 1 and (led or _ROLE_BEFORE.search(before) or _VERB_BEFORE.search(before)) and (turned := _TURNED.match(t, b)):
            b, led = turned.end(), True
        if len(run) > 1 or led:
            yield a, b
    if _CJK.search(t):
        for m in CJK_NAME.finditer(t):
            before = (lead + q[max(0, m.start() - 40):m.start()])[-40:]
            if " " in m.group() or "　" in m.group() or _PERSON.search(t[max(0, m.start() - 12):m.start()]) or _ROLE_BEFORE.search(before) or _VERB_BEFORE.search(before) or _PERSON_AFTER.match(q[m.end():m.end() + 12]):
                yield m.start(), m.end()


def _proposals(t: str, q: str, lead: str, things: frozenset[str]) -> Iterator[tuple[str, int, int]]:
    """Spans of one sentence that may be personal, wide rather than sure."""
    if _AT.search(t):
        for m in EMAIL.finditer(t):
            yield "EMAIL", m.start(), m.end()
    numbered = _DIGIT.search(t) is not None
    if numbered:
        for m in ID.finditer(t):
            yield "ID_NUMBER", m.start(), m.end()
        for a, b in _numbers(t):
            yield "PHONE", a, b
    if _HOUSE.search(t):
        last = -1
        for a, b in sorted((m.start(), -m.end()) for p in ADDRESSES for m in p.finditer(t)):
            if a >= last:
                yield "ADDRESS", a, -b
                last = -b
    for a, b in _names(t, q, lead, things):
        yield "NAME", a, b


@lru_cache(maxsize=100_000)
def _bucket(text: str) -> int:
    return zlib.crc32(text.encode()) % BUCKETS


class Reader:
    """Proposed spans of texts, with votes and the classifier's features; ``things`` are words of no person's name."""

    def __init__(self, things: Iterable[str] = (), remembered: int = REMEMBERED):
        self.things = frozenset(THINGS | set(things)) - SURNAMES
        self.of_sentence = lru_cache(maxsize=remembered)(self._of_sentence)

    def _of_sentence(self, lead: str, t: str) -> list[tuple]:
        q, out = plain(t), []
        for kind, a, b in _proposals(t, q, lead, self.things):
            s = Seen(t, q, a, b, lead, self.things)
            votes = [f(s) for f in LABELERS[kind].values()]
            left, right = _AROUND.findall(s.before)[-3:], _AROUND.findall(s.after)[:3]
            shape = _REPEATED.sub(r"\1+", _DIGITS.sub("9", _LETTERS.sub("a", q[a:b])))[:16]
            around = [f"l{i}|{'9' if w.isdigit() else w}" for i, w in enumerate(left[::-1])] + [f"r{i}|{'9' if w.isdigit() else w}" for i, w in enumerate(right)]
            named = [f"{kind}|bias", *(f"{kind}|v{i}|{v}" for i, v in enumerate(votes) if v), f"{kind}|shape|{shape}", *(f"{kind}|{w}" for w in around)]
            out.append((kind, a, b, votes, [_bucket(x) for x in named]))
        return out

    def spans_of(self, text: str) -> list[dict]:
        t, back = normal(text)
        out, lead = [], ""
        for i, j in sentences(t):
            sentence = t[i:j]
            for kind, a, b, votes, features in self.of_sentence(lead, sentence):
                a, b = a + i, b + i
                out.append({"pii_type": kind, "a": back[a] if back else a, "b": back[b] if back else b, "votes": votes, "features": features})
            end = sentence.rstrip()
            lead = plain(end[-24:]) + " " if end[-1:] in (",", ":") else ""  # a greeting or label that the next line belongs to
        return out


def spans_of(text: str) -> list[dict]:
    """Proposed spans of one text, read without a reference list."""
    return Reader(remembered=0).spans_of(text)


#: What a labeler is taken to be before any count: its (no, abstain, yes) votes on real and on other spans.
PRIOR_REAL, PRIOR_OTHER = np.array([0.03, 0.47, 0.5]), np.array([0.4, 0.57, 0.03])


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 60, belief: float = 0.1, silence: float = 1.0) -> tuple[dict[tuple[int, ...], float], list[tuple[np.ndarray, np.ndarray]]]:
    """The probability that a span is real, for each vote pattern, by expectation-maximisation; and each labeler's (no, abstain, yes) on real and on other spans.

    The prior (labelers are better than chance) counts as ``belief`` times all spans, which keeps the
    two kinds from trading places where nearly all spans are of one; the first guess is the majority of votes.
    An abstention is evidence too, and counts ``silence`` of a vote: all of it where labelers abstain
    independently, less where their cues stand for one another, so that a span led by a form of address
    says nothing by having no role before it.
    """
    keys = list(patterns)
    v = np.array(keys, int) + 1
    n = np.array([patterns[k] for k in keys], float)
    total = (v - 1).sum(1)
    p = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
    labelers: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        odds, labelers = np.full(len(keys), np.log((n * p).sum() + 1) - np.log((n * (1 - p)).sum() + 1)), []
        for j in range(v.shape[1]):
            real = np.bincount(v[:, j], n * p, 3) + belief * n.sum() * PRIOR_REAL
            other = np.bincount(v[:, j], n * (1 - p), 3) + belief * n.sum() * PRIOR_OTHER
            labelers.append((real / real.sum(), other / other.sum()))
            odds += ((np.log(labelers[-1][0]) - np.log(labelers[-1][1])) * (1, silence, 1))[v[:, j]]
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(keys, p.tolist())), labelers


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 60, belief: float = 0.1, silence: float = 1.0) -> dict[tuple[int, ...], float]:
    return estimate(patterns, rounds, belief, silence)[0]


def train_classifier(features: list[list[int]], targets: np.ndarray, rounds: int = 150, ridge: float = 1e-4) -> np.ndarray:
    """Weights of a logistic classifier on soft labels, by full-batch Adagrad from zero."""
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    cols = np.fromiter((x for f in features for x in f), np.int64, len(rows))
    w, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    for _ in range(rounds):
        z = np.bincount(rows, w[cols], len(features))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - targets
        g = np.bincount(cols, error[rows], BUCKETS) / max(1, len(features)) + ridge * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def candidates(df: DataFrame, id_col: str, text_col: str, things: Iterable[str] = ()) -> DataFrame:
    """Every proposed span, written to the checkpoint folder: texts are read by Python once."""
    shared = df.sparkSession.sparkContext.broadcast(frozenset(things))  # words of a reference list
    asked = df.where(F.col(text_col).rlike(r"\S")).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            rows, spans = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = reader.spans_of(text)
                rows += [i] * len(found)
                spans += found
            at = pa.array(rows, pa.int64())
            flat = lambda k: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(s[k]) for s in spans)]), pa.int32()), pa.array([x for s in spans for x in s[k]], pa.int32()))
            one = lambda k, kind: pa.array([s[k] for s in spans], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), one("pii_type", pa.string()), one("a", pa.int32()), one("b", pa.int32()), flat("votes"), flat("features")],
                names=["id", "h", "pii_type", "a", "b", "votes", "features"])

    return checkpointed(asked.mapInArrow(propose, f"id {asked.schema['id'].dataType.simpleString()}, h bigint, pii_type string, a int, b int, votes array<int>, features array<int>"))


def vote_patterns(spans: DataFrame) -> dict[str, dict[tuple[int, ...], int]]:
    """How often each vote pattern occurs, by kind: sums over all spans, at most 3 to the number of labelers whatever the data, and some hundreds in practice."""
    out: dict[str, dict[tuple[int, ...], int]] = {}
    for r in spans.groupBy("pii_type", "votes").agg(F.count(F.lit(1)).alias("n")).collect():
        out.setdefault(r.pii_type, {})[tuple(r.votes)] = r.n
    return out


def labelers(df: DataFrame, id_col: str, text_col: str, things: Iterable[str] = ()) -> DataFrame:
    """(pii_type, labeler, spans, yes, no, yes_on_real, yes_on_other, no_on_real, no_on_other): what each labeler said, and how often it is estimated to say so of real and of other spans."""
    rows = []
    for kind, patterns in sorted(vote_patterns(candidates(df, id_col, text_col, things)).items()):
        _, estimated = estimate(patterns, silence=SILENCE)
        for j, (name, (real, other)) in enumerate(zip(LABELERS[kind], estimated)):
            said = {x: sum(n for v, n in patterns.items() if v[j] == x) for x in (-1, 0, 1)}
            rows.append((kind, name, sum(said.values()), said[1], said[-1], *(round(float(x), 4) for x in (real[2], other[2], real[0], other[0]))))
    schema = "pii_type string, labeler string, spans bigint, yes bigint, no bigint, yes_on_real double, yes_on_other double, no_on_real double, no_on_other double"
    return df.sparkSession.createDataFrame(rows, schema)


def span_model(spans: DataFrame, sample_spans: int = SAMPLE_SPANS) -> np.ndarray:
    """The classifier's weights: reliabilities from all vote patterns, training on a bounded sample of spans."""
    patterns = vote_patterns(spans)
    real = {k: reliabilities(p, silence=SILENCE) for k, p in patterns.items()}
    total = sum(n for p in patterns.values() for n in p.values())
    if not total:
        return np.zeros(BUCKETS)
    drawn = F.xxhash64(F.lit(5), "id", "h", "pii_type", "a")
    part = spans if total <= sample_spans else spans.where(F.pmod(drawn, F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, 1.05 * sample_spans / total)) + 1))  # so that not every task sorts its share
    sample = part.orderBy(drawn, "id", "h", "pii_type", "a").limit(sample_spans).select("pii_type", "votes", "features").toPandas()
    targets = np.array([real[k][tuple(v)] for k, v in zip(sample.pii_type, sample.votes)])
    seen = [list(f) for f in sample.features]
    votes_only = [f[:1 + sum(x != 0 for x in v)] for f, v in zip(seen, sample.votes)]  # twice each, so that unknown words around a span leave the votes their say
    return train_classifier(seen + votes_only, np.concatenate([targets, targets]))


def score(features: Column, weights: np.ndarray) -> Column:
    table = F.from_json(F.lit(json.dumps([round(float(x), 6) for x in weights])), "array<double>")  # folded to a literal
    z = F.aggregate(features, F.lit(0.0), lambda s, f: s + table[f])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def best_spans(scored: DataFrame) -> DataFrame:
    """(id, h, pii_type, a, b, sure) without overlaps: of overlapping spans the earlier kind of TYPES, then the surer, then the longer stays."""
    order = F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("pii_type"))
    by_place = Window.partitionBy("id", "h").orderBy("a", "b", "pii_type")
    reach = F.max("b").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    apart = scored.withColumn("apart", F.coalesce((F.col("a") >= reach).cast("int"), F.lit(0))).withColumn("knot", F.sum("apart").over(by_place))  # spans of other knots do not touch
    one = F.struct(order.alias("o"), (-F.round("sure", 6)).alias("unsure"), (F.col("a") - F.col("b")).alias("short"), "a", "b", "pii_type", "sure")
    knots = apart.groupBy("id", "h", "knot").agg(F.array_sort(F.array_distinct(F.collect_list(one))).alias("s"))
    kept = F.aggregate(
        "s", F.slice("s", 1, 0),
        lambda done, x: F.when(F.exists(done, lambda d: (d["a"] < x["b"]) & (x["a"] < d["b"])), done).otherwise(F.concat(done, F.array(x))))
    return knots.select("id", "h", F.explode(kept).alias("s")).select("id", "h", "s.pii_type", "s.a", "s.b", "s.sure")


def find(df: DataFrame, id_col: str, text_col: str, least: float = 0.5, things: Iterable[str] = (), weights: np.ndarray | None = None) -> DataFrame:
    """(id, h, pii_type, a, b, sure): the spans found; ``h`` is the hash of the text they are in, ``b`` their end.

    ``weights`` are those of a model trained before (``span_model``); else it is trained on ``df`` itself.
    """
    spans = candidates(df, id_col, text_col, things)
    weights = span_model(spans) if weights is None else weights
    return best_spans(spans.withColumn("sure", score(F.col("features"), weights)).where(F.col("sure") >= least))


def redact(df: DataFrame, id_col: str, text_col: str, spans: DataFrame) -> DataFrame:
    """(id_col, redacted): every text with ``[TYPE]`` in place of each span, all else unchanged."""
    per = spans.groupBy("id", "h").agg(F.array_sort(F.collect_list(F.struct("a", "b", "pii_type"))).alias("s"))
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_h"))
    joined = texts.join(per, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_h") == F.col("h")), "left")
    text = F.col("_text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("upto"))

    def put(acc: Column, s: Column) -> Column:
        between = F.substr(text, acc["upto"] + 1, s["a"] - acc["upto"])
        return F.struct(F.concat(acc["out"], between, F.lit("["), s["pii_type"], F.lit("]")).alias("out"), s["b"].alias("upto"))

    done = F.aggregate("s", start, put, lambda acc: F.concat(acc["out"], F.substr(text, acc["upto"] + 1)))
    return joined.select(F.col("_id").alias(id_col), F.when(F.col("s").isNull(), text).otherwise(done).alias("redacted"))
