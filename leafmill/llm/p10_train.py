"""Trainer of the network of problem 10: writes labelled text by rule, fits the weights, and stores them beside the operator.

    python -m leafmill.llm.p10_train --samples subject_samples.parquet [--steps N] [--workers N]

Persons, places and numbers are put together from syllables and digit groups after public national formats; what stands around them comes
from the label and sentence lists below, from rule-written sentences about orders, builds and parts that are no personal data, and from
labelled sample sentences (a table of fixed size) as background. The weights are a few tens of kB; tests train a smaller network anew.
"""

from __future__ import annotations

import argparse
import random
import re
from collections.abc import Iterator

import numpy as np

from .p10_personal import HIDDEN, KINDS, TAGS, WEIGHTS, Net, char_ids

#: Characters of a training window.
LENGTH = 160

_ONSET = "b bl br c ch cl d dr f fl fr g gl gr h j k kl kn l m n p ph pl pr qu r s sch sh sl st str t th tr v w y z".split()
_NUCLEUS = "a e i o u a e i o ai ea ee ie oa ou au ei ö ü é è á í ó".split()
_CODA = "l n r s t m ck rd nd lt rn th x ld mp ns rk ss ff b g".split()
_ENDING = "son sen ton by well field worth man berg burg brook thorn wood vik moor dale wyn quell mere hagen stein court mont lieu rive ville ier eau ez ini elli owski ova escu idis oğlu ström holm feld bach".split()
_COMMON_GIVEN = "Anna James Maria John Laura Peter Emma Paul Lena Thomas Julia Martin Sophie Daniel Clara Michael Jonas Marie Louis Camille Pierre Jeanne Hans Karin Jan Eva Nina Omar Amina Ivan Olga Carlos Lucia Marco Elena".split()
_COMMON_FAMILY = "Smith Jones Brown Taylor Walker Baker Müller Schmidt Fischer Weber Becker Wagner Martin Bernard Dubois Moreau Laurent Garcia Lopez Rossi Novak Kowalski Jansen Nilsson Larsen Petrov Silva Khan Singh Okafor".split()
_PARTICLES = ["von ", "van ", "de ", "van der ", "du ", "di ", "zu ", "da ", "al-", "El ", "O'", "Mc", "Le ", "d'"]
_FAR = {
    "cyrillic": ("бвгдзклмнпрстфхчш", "аеиоуыя", "н к в й р л с м".split(), ["ов", "ев", "ин", "ский", "ова", "енко"]),
    "greek": ("βγδζθκλμνξπρστφχ", "αειουωη", "ς ν ρ λ".split(), ["ος", "ης", "άκης", "ίδης", "ου"]),
    "latin": ("bcčćdđfghjklłmnńprřsšśtťvwzžź", "aáąäåeęéěiíoøöóuůüý", "ń ř ş ţ k n r l s".split(), ["ová", "ský", "ak", "ić", "ström", "ğlu", "yk"]),
}

LABELS = {
    "en": {
        "email": ["Email", "E-mail", "Mail", "e-mail address", "From", "To", "Cc"],
        "phone": ["Phone", "Tel", "Tel.", "Telephone", "Mobile", "Cell", "Fax", "Hotline", "phone no."],
        "id_number": ["SSN", "Social security number", "Passport no.", "Passport number", "Passport", "NI number", "NI no.", "National insurance number", "Tax ID", "TIN", "ID no.", "Identity card", "Driver's licence"],
        "address": ["Address", "Home address", "Postal address", "Residence", "Delivery address"],
        "name": ["Name", "Author", "Signed", "Contact", "Contact person", "Reviewer", "Editor", "Owner", "Prepared by", "Approved by", "Attn.", "Minutes"],
    },
    "de": {
        "email": ["E-Mail", "Mail", "Mailadresse", "Kontakt"],
        "phone": ["Telefon", "Tel.", "Mobil", "Handy", "Fax", "Rufnummer", "Durchwahl"],
        "id_number": ["Steuer-ID", "IdNr.", "Steueridentifikationsnummer", "Personalausweis", "Reisepass", "Sozialversicherungsnummer", "Ausweisnummer", "Ausweis-Nr."],
        "address": ["Adresse", "Anschrift", "Wohnanschrift", "Wohnort", "Lieferadresse"],
        "name": ["Name", "Verfasser", "Verfasserin", "Bearbeiter", "Autor", "Unterschrift", "gez.", "Ansprechpartner", "Ansprechpartnerin", "Prüfer", "Protokoll"],
    },
    "fr": {
        "email": ["Courriel", "E-mail", "Mél", "Adresse électronique"],
        "phone": ["Téléphone", "Tél.", "Portable", "Fax", "Mobile"],
        "id_number": ["NIR", "N° de sécurité sociale", "Numéro de sécurité sociale", "Passeport", "Carte d'identité n°", "n° de sécu"],
        "address": ["Adresse", "Domicile", "Adresse postale"],
        "name": ["Nom", "Auteur", "Autrice", "Rédacteur", "Signé", "Relecture", "Contact", "Rapporteur"],
    },
    "zh": {
        "email": ["邮箱", "电子邮箱", "邮件", "电邮"],
        "phone": ["电话", "手机", "联系电话", "传真", "手机号"],
        "id_number": ["身份证", "身份证号", "身份证号码", "证件号", "证件号码", "身份证件", "护照号", "护照号码"],
        "address": ["地址", "住址", "家庭住址", "通讯地址", "收货地址"],
        "name": ["姓名", "联系人", "作者", "审核人", "负责人", "签名", "经办人", "签字", "记录人"],
    },
}
#: Sentences around a value, whose place is marked by @.
FRAMES = {
    "en": {
        "email": ["Please write to @ with any questions.", "cc @ on the reply", "She asked us to forward it to @ today.", "Use @ for invoices only.", "You may also try @, which is read daily.", "Sent from @ on Tuesday", "Reach me under @ or by post.", "(@)", "forwarded by @", "The note to @ bounced."],
        "phone": ["Please ring @ after six.", "dial @ for support", "My number is @, leave a message.", "The hotline (@) is open all week.", "You can text @ at any time.", "He left @ as a callback number.", "Nobody picks up on @.", "or phone @ instead"],
        "id_number": ["Her social security number, @, was blacked out.", "The applicant's passport (@) expires in May.", "Please quote your insurance number @ on all letters.", "His licence no. is @.", "ID card @ was shown at the desk.", "The taxpayer with number @ has moved.", "She travelled on passport @.", "We copied identity number @."],
        "address": ["They moved to @ in spring.", "Our new office is at @.", "Parcels should be sent to @, please.", "The house at @ was sold.", "He lives in @.", "Visit us at @", "pick-up point @", "The keys are kept at @ now."],
        "name": ["I spoke with @ about the delay.", "@ wrote the first chapter.", "The letter to @ came back.", "Thanks to @ for the photographs.", "@ and her brother were present.", "All questions were answered by @, who led the work.", "Yours sincerely,\n@\n", "We met @ at noon.", "as @ put it", "the late @", "@'s proposal was accepted.", "The office of @ replied.", "a photograph by @", "@ has retired.", "with @ in the chair", "Ask @ for the key."],
    },
    "de": {
        "email": ["Schreiben Sie bitte an @.", "Die Unterlagen gehen an @ zurück.", "per Mail (@)", "Unter @ antwortet das Team.", "Die Nachricht an @ kam nicht an."],
        "phone": ["Rufen Sie uns unter @ an.", "Wir sind unter der Nummer @ zu sprechen.", "Bitte @ wählen.", "Unter @ meldet sich niemand.", "oder telefonisch: @"],
        "id_number": ["Die Steuernummer @ steht oben rechts.", "Ihr Reisepass (@) läuft bald ab.", "mit dem Ausweis @", "Die persönliche Kennnummer @ wurde geschwärzt.", "Versichert unter @."],
        "address": ["Sie zieht nach @ um.", "Das Büro liegt hier: @", "Das Paket ging an @ zurück.", "Er wohnt jetzt @.", "Das Haus @ steht leer.", "Abzuholen ist es @."],
        "name": ["Gestern hat @ angerufen.", "Mit freundlichen Grüßen\n@\n", "Das Wort führte @.", "Wir danken @ für die Hilfe.", "@ und seine Schwester waren dabei.", "Die Idee stammt von @, nicht vom Amt.", "im Auftrag von @", "so @ gestern", "Der Brief an @ kam zurück.", "Fragen beantwortet @ gern."],
    },
    "fr": {
        "email": ["Merci d'écrire à @.", "Les pièces partent à @ avant lundi.", "Répondre à @", "Le message pour @ est revenu."],
        "phone": ["Appelez le @ après dix heures.", "On peut nous joindre au @.", "composer le @", "Personne ne répond au @."],
        "id_number": ["Son numéro de sécurité sociale est le @.", "Le passeport @ expire bientôt.", "sous l'identifiant @", "Assurée sous le numéro @."],
        "address": ["Elle habite @.", "Le colis part au @.", "Nos bureaux se trouvent @.", "La maison du @ est vide."],
        "name": ["Hier, @ a téléphoné.", "Nous remercions @ pour son aide.", "Cordialement,\n@\n", "Le texte de @ est joint.", "@ et sa sœur étaient présents.", "d'après @", "La lettre à @ est revenue.", "confié à @"],
    },
    "zh": {
        "email": ["有问题请写信到@。", "请将材料发送到@", "回复请寄@。", "发往@的信被退回。"],
        "phone": ["可拨打@咨询。", "请打@联系我们。", "她的手机号是@。", "@无人接听。"],
        "id_number": ["其身份证为@。", "资料里写着@。", "表上填的是@。", "护照@即将到期。", "证件（@）已核对。", "持证人号码@。"],
        "address": ["他搬到了@。", "包裹寄往@。", "公司位于@。", "家住@", "@的房子空着。"],
        "name": ["昨天@来过电话。", "感谢@的帮助。", "@和同事都到场了。", "由@负责翻译。", "我们在门口见到了@。", "@说，材料已寄出。", "主讲人@", "给@的信被退回。", "@主持了会议。", "据@回忆，当天下雨。", "@的方案获得通过。"],
    },
}
#: (nouns, what is said of them): numbers that are no personal data.
THINGS = {
    "en": (["Order", "Purchase order", "Batch", "Lot", "Shipment", "Ticket", "Invoice", "Serial number", "Catalogue number", "Article", "Model", "Firmware", "Build", "Release", "Version", "Router", "Host", "Node", "Port", "ISBN", "Issue", "Docket", "Drawing", "Part no.", "Spare part", "Container", "Sample", "Room", "Gate", "Form"], ["was returned unopened.", "arrived two days late.", "is out of stock.", "has been withdrawn.", "went to the archive.", "needs a new label.", "is listed twice.", "stays in use until March.", "follows next week.", "was recalled by the maker.", "supersedes", "and"]),
    "de": (["Auftrag", "Bestellung", "Los", "Charge", "Lieferung", "Rechnung", "Artikel", "Seriennummer", "Baureihe", "Ausgabe", "Server", "Anschluss", "Bauteil", "Teil", "Palette", "Probe", "Aktenzeichen", "ISBN", "Raum", "Modell"], ["kam zu spät.", "ist vergriffen.", "wurde zurückgenommen.", "liegt im Archiv.", "fehlt noch.", "wurde umgebucht.", "sowie", "gilt bis März."]),
    "fr": (["Commande", "Lot", "Facture", "Article", "Série", "Modèle", "Serveur", "Dossier", "Palette", "Pièce", "Volume", "ISBN", "Salle", "Réseau"], ["arrive en retard.", "n'est plus disponible.", "a été retiré.", "reste à vérifier.", "ainsi que", "passe en mars."]),
    "zh": (["订单", "批次", "发票", "型号", "序列号", "版本", "服务器", "货号", "零件", "样品", "案卷", "ISBN", "端口", "房间", "箱号"], ["已退回。", "仍缺货。", "已经归档。", "需要复核。", "下月到货。", "已作废。", "以及"]),
}
_PLACES = "Bridge Market Harbour Depot Station Hall Gate Tower Library Museum Valley River Pump Engine Valve Index Review Report Office Building Council Institute University Committee Systems Ltd GmbH Press Line Series Protocol".split()
_ROLES = ["Head of Finance", "Deputy Director", "Chief Engineer", "Ministry of Works", "Board of Trustees", "Leiter Einkauf", "Abteilung Technik", "Referat Haushalt", "Chef de Projet", "Direction Générale", "Technical Committee", "Senior Clerk", "Public Prosecutor"]


class Writer:
    """Text with spans (start, end, kind number)."""

    def __init__(self, seed: int, background: list[str]):
        self.r = random.Random(seed)
        self.background = background or ["The list was read twice and put away."]
        latin = [w for s in self.background for w in re.findall(r"[A-Za-zÀ-ÿ]{4,}", s)]
        self.words = latin or ["list", "paper"]
        self.han_runs = [h for s in self.background for h in re.findall("[一-鿿]{4,}", s)] or ["名单已经核对并存放"]
        # Common Chinese family names, characters of given names and of place names.
        self.family = list("王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎易常武乔贺赖龚文宓柯卓裴甄阮闻阙容岑缪晏桑") + ["欧阳", "司马", "上官", "诸葛", "东方", "皇甫", "尉迟", "公孙", "慕容", "令狐", "宇文", "长孙", "司徒", "夏侯", "即墨"]
        self.given = list("伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂建国华英玉兰梅琳雪梦琪子涵宇轩浩然欣怡思远雨晨佳豪嘉慧文博志远疏桐听澜栖白砚秋泊舟望舒知若溪景行云松鹤清和安宁远山海川")
        self.place = list("云桥临江青河白石南浦东岭平川清源长宁安和金山海湖西北阳州新丰泰永兴华城")

    # ---- parts
    def d(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def syllable(self) -> str:
        r = self.r
        return r.choice(_ONSET) + r.choice(_NUCLEUS) + (r.choice(_CODA) if r.random() < 0.5 else "")

    def cap(self, least: int = 1, most: int = 2) -> str:
        s = "".join(self.syllable() for _ in range(self.r.randint(least, most)))
        return s[:1].upper() + s[1:]

    def surname(self) -> str:
        roll = self.r.random()
        if roll < 0.1:
            return self.r.choice(_COMMON_FAMILY)
        if roll < 0.4:  # of a word and an ending
            return self.r.choice(self.words)[: self.r.randint(3, 7)].capitalize() + self.r.choice(_ENDING)
        return self.cap(1, 2) + self.r.choice(_ENDING) if self.r.random() < 0.6 else self.cap(2, 3)

    def far_word(self, script: str, family: bool) -> str:
        on, nuc, coda, end = _FAR[script]
        r = self.r
        s = "".join(r.choice(on) + r.choice(nuc) for _ in range(r.randint(1, 2))) + (r.choice(end) if family else r.choice(coda))
        return s[:1].upper() + s[1:]

    # ---- values
    def name(self, lang: str) -> str:
        r = self.r
        if lang == "zh":
            return r.choice(self.family) + "".join(r.choice(self.given) for _ in range(r.choice([1, 2, 2, 2])))
        far = r.choice(list(_FAR)) if r.random() < 0.15 else None
        first = self.far_word(far, False) if far else r.choice(_COMMON_GIVEN) if r.random() < 0.15 else self.cap(1, 2) if r.random() < 0.7 else self.cap(1, 1) + r.choice("a e is en in an yn el or ette ine ian ert win".split())
        last = self.far_word(far, True) if far else self.surname()
        roll = r.random()
        if roll < 0.08:
            last += "-" + (self.far_word(far, True) if far else self.surname())
        elif roll < 0.14:
            first += "-" + self.cap(1, 1)
        elif roll < 0.2:
            last = r.choice(_PARTICLES) + last
        form = r.random()
        if form < 0.52:
            return f"{first} {last}"
        if form < 0.66:
            return f"{first[0]}. {last}" if r.random() < 0.85 else f"{first[0]}. {self.cap()[0]}. {last}"
        if form < 0.78:
            return f"{last}, {first}" + (f" {self.cap()[0]}." if r.random() < 0.1 else "")
        if form < 0.87:
            return f"{first} {self.cap()[0]}. {last}" if r.random() < 0.7 else f"{first} {self.cap()} {last}"
        if form < 0.95:
            return f"{last.upper()} {first}" if r.random() < 0.6 else f"{first} {last.upper()}"
        return f"{first} {last}".upper()

    def titled(self, lang: str) -> tuple[str, str]:
        t = {"en": ["Dr. ", "Ms ", "Mr ", "Mrs ", "Prof. ", "Dr ", "Miss "], "de": ["Frau ", "Herr ", "Dr. ", "Herrn ", "Frau Dr. "], "fr": ["M. ", "Mme ", "Me ", "Mlle "], "zh": [""]}[lang]
        return (self.r.choice(t) if self.r.random() < 0.2 else "", self.name(lang))

    def email(self) -> str:
        r = self.r
        a, b = self.cap(1, 2).lower(), self.surname().lower()
        user = r.choice([f"{a}.{b}", f"{a}_{b}", f"{a[0]}{b}", f"{a[0]}.{b}", f"{b}{r.randint(1, 999)}", f"{a}-{r.randint(1, 400)}", f"{a}+{b}", f"{a}.{b}.{r.randint(1, 9)}", a + b, f"{a}-{b}", r.choice(["info", "office", "press", "team", "desk"]) + r.choice(["", f"-{r.randint(1, 300)}", f".{a}"])])
        host = self.cap(1, 2).lower() + r.choice([".com", ".org", ".net", ".de", ".fr", ".cn", ".co.uk", ".eu", ".info", ".io", ".edu", ".example", ".test", ".invalid", ".example.com", ".example.org"])
        if r.random() < 0.25:
            host = r.choice(["mail", "post", "mx1", "mx", "smtp", "lists"]) + "." + host
        elif r.random() < 0.2:
            host = r.choice(["example.com", "example.org", "example.net", "mail.example"])
        ascii_ = lambda s: re.sub(r"[^\x00-\x7f]", "e", s)
        out = ascii_(user) + "@" + ascii_(host)
        form = r.random()
        if form < 0.16:
            at, dot = r.choice([("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), (" at ", " dot "), ("[at]", "."), (" (at) ", " (dot) "), (" [at] ", ".")])
            u, h = out.split("@")
            out = (u.replace(".", dot) if r.random() < 0.5 else u) + at + h.replace(".", dot)
        elif form < 0.24:
            out = out.upper()
        elif form < 0.3:
            out = out.title()
        elif form < 0.32:
            out = out.replace("@", "＠")
        return out

    def groups(self, sizes: list[int], seps: list[str]) -> str:
        s = self.r.choice(seps)
        return s.join(self.d(n) for n in sizes)

    def phone(self, lang: str) -> str:
        r, d = self.r, self.d
        us = [lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: self.groups([3, 3, 4], ["-", ".", " "]), lambda: "+1 " + self.groups([3, 3, 4], ["-", ".", " "]), lambda: f"1-{d(3)}-{d(3)}-{d(4)}", lambda: f"+1 ({d(3)}) {d(3)}-{d(4)}", lambda: f"1 ({d(3)}) {d(3)} {d(4)}", lambda: f"+1-{d(3)}-{d(3)}-{d(4)}"]
        uk = [lambda: f"0{d(2)} {d(4)} {d(4)}", lambda: f"0{d(4)} {d(6)}", lambda: f"+44 {d(2)} {d(4)} {d(4)}", lambda: f"+44 (0){d(4)} {d(6)}", lambda: f"07{d(3)} {d(6)}", lambda: f"+44 {d(4)} {d(6)}", lambda: f"0{d(3)} {d(3)} {d(4)}"]
        de = [lambda: f"0{d(2)} {d(r.randint(6, 8))}", lambda: f"0{d(3)}/{d(r.randint(5, 7))}", lambda: f"(0{d(3)}) {d(r.randint(5, 7))}", lambda: f"+49 {d(3)} {d(7)}", lambda: f"0049 {d(2)} {d(8)}", lambda: f"0049/{d(3)}/{d(6)}", lambda: f"+49 (0){d(2)} {d(4)}-{d(r.randint(2, 4))}", lambda: f"01{d(2)}-{d(r.randint(7, 8))}", lambda: f"0{d(2)} {d(4)} {d(3)}", lambda: f"0{d(3)} {d(3)} {d(2)} {d(2)}", lambda: f"(0{d(3)}) {d(4)} {d(3)}", lambda: f"+49 {d(2)} {d(8)}"]
        fr = [lambda: "0" + d(1) + (s := r.choice([" ", ".", "-"])) + s.join(d(2) for _ in range(4)), lambda: f"+33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+33 (0){d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"0033 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"0{d(9)}", lambda: f"+33{d(9)}"]
        zh = [lambda: f"1{d(10)}", lambda: f"1{d(2)} {d(4)} {d(4)}", lambda: f"1{d(2)}-{d(4)}-{d(4)}", lambda: f"0{d(2)}-{d(8)}", lambda: f"0{d(3)}-{d(7)}", lambda: f"(0{d(2)}) {d(8)}", lambda: f"（0{d(2)}）{d(8)}", lambda: f"+86 1{d(2)} {d(4)} {d(4)}", lambda: f"+86 1{d(2)}-{d(4)}-{d(4)}", lambda: f"0086 {d(2)} {d(4)} {d(4)}", lambda: f"400-{d(3)}-{d(4)}", lambda: f"+86-{d(2)}-{d(8)}"]
        far = [lambda: f"+{r.randint(2, 9)}{d(r.randint(0, 2))} " + " ".join(d(r.choice([2, 3, 4])) for _ in range(r.choice([3, 3, 4])))]
        return r.choice({"en": us + uk, "de": de, "fr": fr, "zh": zh}[lang] + (far if r.random() < 0.3 else []))()

    def number(self, lang: str) -> tuple[str, bool]:
        """(identity number, whether its form alone tells it)."""
        r, d = self.r, self.d
        up = lambda n, of="ABCDEFGHJKLMNPRSTUVWXYZ": "".join(r.choice(of) for _ in range(n))
        ni = up(2)
        en = [lambda: (f"{d(3)}-{d(2)}-{d(4)}", True), lambda: (f"{d(3)} {d(2)} {d(4)}", False), lambda: (up(1) + d(8), True), lambda: (up(2) + d(7), True), lambda: (f"{ni}{d(6)}{up(1, 'ABCD')}", True), lambda: (f"{ni} {d(2)} {d(2)} {d(2)} {up(1, 'ABCD')}", True), lambda: (d(9), False)]
        de = [lambda: (d(11), False), lambda: (f"{d(2)} {d(3)} {d(3)} {d(3)}", False), lambda: (up(1) + d(8), True), lambda: (f"{d(2)}{d(6)}{up(1)}{d(3)}"[:8] + d(2), False)]
        fr = [lambda: (f"{r.choice('12')}{d(14)}", False), lambda: (f"{r.choice('12')} {d(2)} {d(2)} {d(2)} {d(3)} {d(3)} {d(2)}", True), lambda: (f"{r.choice('12')} {d(2)} {d(2)} {d(2)} {d(3)} {d(3)}", True), lambda: (up(1) + d(8), True)]
        zh = [lambda: (d(6) + r.choice(["19", "20"]) + d(2) + f"{r.randint(1, 12):02d}{r.randint(1, 28):02d}" + d(3) + r.choice("0123456789X"), False), lambda: (d(6) + r.choice(["19", "20"]) + d(2) + r.choice(["01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "11", "12"]) + d(5) + r.choice("0123456789X"), r.random() < 0.6), lambda: (f"{d(6)} {r.choice(['19', '20'])}{d(6)} {d(3)}{r.choice('0123456789X')}", True), lambda: (up(1, "EGDSPK") + d(8), True)]
        return r.choice({"en": en, "de": de, "fr": fr, "zh": zh}[lang])()

    def city(self, lang: str) -> str:
        r = self.r
        if lang == "zh":
            return "".join(r.choice(self.place) for _ in range(2)) + r.choice("市县区镇")
        return r.choice([self.cap(2, 2), self.cap(1, 2) + r.choice(_ENDING), r.choice(["Port ", "North ", "St. ", "Saint-", "Neu-", "Bad ", "Upper ", "Mont-", "La ", "Mount "]) + self.cap(), self.cap() + r.choice([" Falls", "wick", "mere", "furt", "au", "ville", " Bay", "-sur-" + self.cap(1, 1)])])

    def address(self, lang: str) -> str:
        r, d = self.r, self.d
        n = str(r.randint(1, 299)) + (r.choice("abcABC") if r.random() < 0.12 else "")
        if lang == "zh":
            road = "".join(r.choice(self.place + self.given) for _ in range(r.choice([2, 2, 3]))) + r.choice(["路", "街", "巷", "大道", "弄", "里路", "胡同", "东路", "北街"])
            head = (self.city("zh")[:2] + "省" if r.random() < 0.1 else "") + self.city("zh") + (self.city("zh") if r.random() < 0.15 else "")
            return (head if r.random() < 0.85 else "") + road + f"{r.randint(1, 299)}号" + r.choice(["", "", f"{r.randint(1, 9)}单元", f"{r.randint(1, 20)}栋", f"{r.randint(1, 20)}号楼{d(3)}室", f"{r.randint(1, 9)}栋{r.randint(101, 1500)}室", f"{r.randint(1, 30)}楼"])
        between = r.choice([", ", ", ", "\n", " "])
        town = self.city(lang)
        if lang == "en":
            kind = r.choice("Street Road Row Avenue Lane Court Close Drive Mews Way Place Square Terrace Crescent Hill Gardens Walk Yard Park Grove Quay St Rd. Ave. Parade Rise Green Wharf".split())
            street = f"{n} {self.cap(1, 2)}{r.choice(['', '', chr(39) + 's', ' ' + self.cap(), r.choice(_ENDING)])} {kind}"
            if r.random() < 0.12:
                street = f"{r.choice(['Flat', 'Apt', 'Unit'])} {r.randint(1, 40)}, " + street
            elif r.random() < 0.12:
                street += f", {r.choice(['Flat', 'Apt', 'Apt.', 'Unit', 'Floor', 'Suite'])} {r.randint(1, 40)}{r.choice(['', 'A', 'B'])}"
            tail = r.choice([f"{town} {d(5)}", f"{town}, {r.choice('ABCDEFGHIKLMNOPRSTUVW')}{r.choice('ACDEHIJLNRTXYZ')} {d(5)}", f"{town} {r.choice('BCEGLMNSW')}{r.randint(1, 20)} {d(1)}{r.choice('ABDEFGHJLN')}{r.choice('ABDEFGHJLN')}", f"{town} {d(5)}", town])
            return street + (between + tail if r.random() < 0.65 else "")
        if lang == "de":
            stem = self.cap(1, 2)
            street = r.choice([f"{stem}{r.choice(['straße', 'strasse', 'str.', 'weg', 'gasse', 'ring', 'allee', 'platz', 'hof', 'damm', 'ufer', 'steig', 'pfad', 'markt', 'graben', 'berg', 'kamp', 'stieg'])}", f"{r.choice(['Alte ', 'Neue ', 'Obere ', 'Lange '])}{stem}{r.choice(['gasse', 'straße', 'allee'])}", f"{r.choice(['Am ', 'An der ', 'Zum ', 'Im ', 'Unter den ', 'Auf der '])}{stem}", f"{stem}er {r.choice(['Straße', 'Weg', 'Platz', 'Allee', 'Chaussee'])}"])
            return f"{street} {n}" + (between + f"{d(5)} {town}" if r.random() < 0.65 else "")
        street = f"{n}{r.choice([',', '', '', ' bis', ' bis,', ' ter'])} {r.choice(['rue', 'avenue', 'impasse', 'allée', 'boulevard', 'place', 'chemin', 'quai', 'cours', 'square', 'route', 'passage', 'sentier', 'ruelle', 'esplanade', 'montée'])} {r.choice(['des ', 'de la ', 'du ', 'de ', '', 'des ', chr(100) + chr(39)])}{self.cap(1, 2)}{r.choice(['', '', '-' + self.cap(), ' ' + self.cap()])}"
        return street + (between + f"{d(5)} {town}" if r.random() < 0.65 else "")

    def value(self, kind: int, lang: str) -> tuple[str, str, bool]:
        """(words before the span, span, whether the form alone tells the kind)."""
        k = KINDS[kind]
        if k == "name":
            return *self.titled(lang), lang != "zh"
        if k == "id_number":
            return "", *self.number(lang)
        return "", {"email": self.email, "phone": lambda: self.phone(lang), "address": lambda: self.address(lang)}[k](), k != "phone"

    # ---- what is no personal data
    def code(self) -> str:
        r, d = self.r, self.d
        up = lambda n: "".join(r.choice("ABCDEFGHKLMNPRSTVWXZ") for _ in range(n))
        return r.choice([
            lambda: d(r.randint(4, 20)), lambda: d(r.choice([12, 14, 14, 16, 18, 18])), lambda: f"{d(4)}-{d(4)}-{d(r.choice([3, 4]))}", lambda: f"{d(2)}-{d(4)}-{d(r.choice([2, 3]))}", lambda: f"{d(3)}-{d(3)}", lambda: f"{up(2)}-{d(r.randint(3, 5))}", lambda: f"{up(2)}{d(2)}", lambda: f"{up(1)}{d(1)}-{d(2)}",
            lambda: f"{d(1)}.{d(1)}.{r.randint(0, 99)}", lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)), lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.20{d(2)}", lambda: f"20{d(2)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: str(r.randint(1, 999)), lambda: f"{d(1)},{d(3)},{d(3)}",
        ])()

    def thing(self, lang: str) -> str:
        r = self.r
        nouns, said = THINGS[lang]
        gap = "" if lang == "zh" else " "
        out = r.choice(nouns) + gap + self.code() + gap + r.choice(said)
        if not out.endswith((".", "。")):
            out += gap + (r.choice(nouns).lower() if lang == "en" else r.choice(nouns)) + gap + self.code() + ("。" if lang == "zh" else ".")
        return out

    def capitals(self) -> str:
        """Capitalised words that name no person."""
        r = self.r
        w = lambda: r.choice(self.words).capitalize()
        return r.choice([
            lambda: f"The {r.choice(['North', 'Old', 'Upper', 'Central', 'Royal'])} {w()} {r.choice(_PLACES)}", lambda: f"{self.cap()} {r.choice(_PLACES)}", lambda: r.choice(_ROLES), lambda: f"{r.choice(['The', 'Die', 'Der', 'Das', 'Le', 'La', 'How the', 'Für die'])} {w()} {r.choice(self.words)}", lambda: f"{w()} {w()} {self.code()}",
            lambda: f"# {w()} {r.choice(self.words)}: {w()} {self.code()}", lambda: f"{r.choice(['Report', 'Review', 'Bericht', 'Étude', 'Notes', 'Vermerk'])} {self.code()}: {w()}", lambda: f"{self.cap(1, 2)} & {r.choice(['Sons', 'Co.', 'Partners'])}", lambda: f"in {self.city('en')}, {r.choice(self.words)}", lambda: f"{w()} {w()} {w()}",
        ])()

    def counted(self) -> str:
        """A sentence with numbers among its words: counts, years, places in a building."""
        r = self.r
        roll = r.random()
        if roll < 0.25:
            rooms = r.choice([["Room", "Building", "Floor", "Gate", "Wing", "Level"], ["Raum", "Gebäude", "Etage", "Tor", "Flügel"], ["Salle", "bâtiment", "étage", "porte", "aile"], ["Chapter", "page", "table", "figure"]])
            return r.choice([", ", " "]).join(f"{x} {self.d(r.randint(1, 3))}" for x in r.sample(rooms, r.randint(2, 3))) + r.choice(["", " is empty.", " ist frei.", " reste libre."])
        if roll < 0.4:
            w = r.choice(self.words)
            return r.choice([f"{w.capitalize()}: {r.choice(self.words)} 20{self.d(2)}", f"# {w}, {r.choice(['part', 'Teil', 'partie', 'no.', 'Band'])} {r.randint(1, 40)}", f"{w.capitalize()} {self.d(4)}", f"{r.choice(['on day', 'am Tag', 'in week', 'Woche', 'au jour'])} {self.d(r.randint(1, 4))}"]) + r.choice(["\n", " ", ". "])
        s = r.choice(self.background)
        if re.search("[一-鿿]", s):
            at = [r.randrange(len(s)) for _ in range(r.randint(1, 3))]
            return "".join((self.d(r.randint(1, 5)) + r.choice(["号", "个", "条", "", "层", "室", "天", "件", "次", "名", "周", "项"]) if i in at else "") + c for i, c in enumerate(s))[:150]
        words = s.split()
        nouns = [i for i, x in enumerate(words) if x[:1].isupper() and i]
        for _ in range(r.randint(1, 4)):
            at = r.choice(nouns) + r.randint(0, 1) if nouns and r.random() < 0.5 else r.randrange(len(words) + 1)
            words.insert(at, self.d(r.randint(1, 5)) + r.choice(["", "", ",", ".", "?", ";"]))
        if r.random() < 0.15:
            words = [f"`{x}`" if r.random() < 0.4 else x for x in words]
        at = r.randrange(max(1, len(words) - 12))
        s = " ".join(words[at : at + r.randint(5, 18)])
        return s.upper() if r.random() < 0.2 else s

    def code_line(self) -> str:
        r = self.r
        w = lambda: r.choice(self.words).lower() + r.choice(["", "", f"_{r.choice(self.words).lower()}", str(r.randint(1, 99))])
        return r.choice([lambda: f"{w()} --{w()} {r.randint(1, 999)} | {w()} > {w()}.txt", lambda: f"{w()}({w()} {r.choice(['STATIC', 'PRIVATE', 'PUBLIC', 'SHARED'])} {w()}.c {w()}.c)", lambda: f"def {w()}({w()}, {w()}={r.randint(1, 999)}):", lambda: f"    {w()} = {w()}[{r.randint(1, 99)}:{w()}]", lambda: f"for (int i = 0; i < {r.randint(2, 999)}; i++) {w()}(&{w()}[i]);", lambda: f"// {w()} {w()} {r.randint(1, 9999)} {w()}", lambda: f"<{w()} id=\"{w()}\" size=\"{r.randint(1, 99)}\">"])()

    def handles(self) -> str:
        r = self.r
        w = lambda: r.choice(self.words).lower()
        return r.choice([lambda: f"@{w()}", lambda: f"{w()}@{r.randint(0, 9)}.{r.randint(0, 99)}", lambda: f"{w()}@{r.randint(1, 9)}", lambda: f"look at {w()}.{w()}()", lambda: f"https://{w()}.example/{w()}"])()

    def filler(self, lang: str) -> str:
        r = self.r
        roll = r.random()
        if roll < 0.18:
            return self.thing(lang)
        if roll < 0.34:
            return self.counted()
        if roll < 0.38:
            return "\n" + self.code_line() + "\n"
        if roll < 0.5:
            return self.capitals() + r.choice([" ", ".", "\n"])
        if roll < 0.54:
            return self.handles() + " "
        if lang == "zh" and roll < 0.76:
            run = r.choice(self.han_runs)
            at = r.randrange(len(run) - 2)
            term = run[at : at + r.randint(2, 6)]
            return "\n" + r.choice([f"* {term}", f"+ {term}", f"- {term}", f"1. {term}", f"## {term}与{term[:2]}说明", f"# {term}手册第{r.randint(1, 60)}册", f"![{term}](assets/{r.randint(1, 9)}.png)", f"[{term[:3]}](notes/{term[:2]}.md)", f"| {term} | {term} |", f"> {run}", f"{term}：{run}"]) + "\n"
        if lang == "zh" and r.random() < 0.4:  # how Chinese sentences begin, which looks like a name and what someone did
            run = r.choice(self.han_runs)
            n = r.randint(2, 4)
            return r.choice(["\n\n", "。", "**", "\n> ", ""]) + r.choice([run, run[:n] + r.choice(["**", "~~", "的", "，"]) + run[n:]]) + r.choice(["，", "。", ""])
        s = r.choice(self.background)
        at = r.randrange(max(1, len(s) - 120)) if r.random() < 0.6 else 0
        s = s[at : at + r.randint(20, 140)] + r.choice(["", ". ", " "])
        if lang == "zh" and r.random() < 0.25 and len(s) > 8:  # a sentence that goes on in the next line
            cut = r.randrange(3, len(s) - 3)
            s = s[:cut] + "\n" + s[cut:]
        return s.upper() if r.random() < 0.08 else s.title() if r.random() < 0.04 else s

    def chunk(self) -> tuple[str, list[tuple[int, int, int]]]:
        r = self.r
        out: list[str] = []
        spans: list[tuple[int, int, int]] = []
        size = 0
        lang = r.choice(["en", "en", "de", "de", "fr", "zh", "zh"])

        def say(s: str) -> None:
            nonlocal size
            out.append(s)
            size += len(s)

        def put(kind: int, value: str) -> None:
            spans.append((size, size + len(value), kind))
            say(value)

        def one(kind: int) -> tuple[str, str]:
            return self.value(kind, lang)[:2]

        while size < LENGTH * 1.3:
            roll = r.random()
            kind = r.choice([0, 1, 2, 3, 4, 4])
            if roll < 0.2:  # a sentence around the value
                a, b = r.choice(FRAMES[lang][KINDS[kind]]).split("@")
                before, value = one(kind)
                say(a + before), put(kind, value), say(b)
            elif roll < 0.34:  # a label
                before, value = one(kind)
                label = r.choice(LABELS[lang][KINDS[kind]])
                sep = r.choice([": ", " ", ": ", "\t", " | "]) if lang != "zh" else r.choice(["：", ":", "", " "])
                say((r.choice(["", "**", "- ", "| "]) if r.random() < 0.3 else "") + label + sep + before), put(kind, value), say(r.choice([".", "\n", " ", ", ", " |"]) if lang != "zh" else r.choice(["。", "\n", "，"]))
            elif roll < 0.41:  # in the middle of a sentence, where the form tells the kind
                before, value, tells = self.value(kind, lang)
                if not tells:
                    continue
                s = r.choice(self.background)
                cut = [i for i, c in enumerate(s) if c in " ，、"] or [len(s)]
                at = r.choice(cut)
                quote = r.choice([("", ""), ("(", ")"), ("“", "”"), ("**", "**")]) if r.random() < 0.3 else ("", "")
                say(s[max(0, at - r.randint(5, 60)) : at] + " " + before + quote[0]), put(kind, value), say(quote[1] + s[at : at + r.randint(5, 60)])
            elif roll < 0.5:  # a card or a row
                sep = r.choice([", ", " | ", "\n", " | ", "\n", "; ", " – "])
                for i, k in enumerate([4, *r.sample([3, 1, 0, 2], r.randint(1, 3))]):
                    before, value = one(k)
                    say((sep if i else "") + before), put(k, value)
                say(r.choice(["\n", ".", " "]))
            elif roll < 0.53:  # a line of its own
                say("\n"), put(kind, one(kind)[1]), say("\n")
            elif roll < 0.555:  # a link or brackets around an address
                value = self.email()
                if r.random() < 0.5:
                    say("["), put(0, value), say("](mailto:"), put(0, value), say(")")
                else:
                    say("<"), put(0, value), say(">")
            else:
                say(self.filler(lang))
            say(r.choice([" ", "\n", " ", "\n\n"]) if lang != "zh" else r.choice(["", "", "\n"]))
        text = "".join(out)
        if r.random() < 0.12:  # running text broken into lines
            at = 0
            line = r.randint(30, 80)
            chars = list(text)
            while (at := text.find(" ", at + line)) > 0:
                chars[at] = "\n"
            text = "".join(chars)
        return text, spans


def spans_by_rule(n: int, background: list[str], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """n full windows of characters and their tags."""
    w = Writer(seed, background)
    x, y = np.zeros((n, LENGTH), np.int16), np.zeros((n, LENGTH), np.int8)
    for i in range(n):
        text, spans = w.chunk()
        tag = np.zeros(len(text), np.int8)
        for a, b, k in spans:
            tag[a:b] = k + 1
        at = w.r.randint(0, len(text) - LENGTH) if w.r.random() < 0.75 else 0
        x[i], y[i] = char_ids(text)[at : at + LENGTH], tag[at : at + LENGTH]
    return x, y


def gradient(net: Net, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Negative log-likelihood per window and its gradient; all windows are of one length."""
    n, top = x.shape
    y = y.astype(np.int64)
    xs = np.stack([x, x[:, ::-1]]).astype(np.int64)
    h = np.zeros((2, n, HIDDEN), np.float32)
    c = np.zeros_like(h)
    hs, cs, gates, tcs = [h], [c], [], []
    for t in range(top):
        z = np.matmul(net.embed[xs[:, :, t]], net.wx) + np.matmul(h, net.wh) + net.b
        s = 1 / (1 + np.exp(-z[:, :, : 3 * HIDDEN]))
        g = np.tanh(z[:, :, 3 * HIDDEN :])
        c = s[:, :, HIDDEN : 2 * HIDDEN] * c + s[:, :, :HIDDEN] * g
        tc = np.tanh(c)
        h = s[:, :, 2 * HIDDEN :] * tc
        hs.append(h), cs.append(c), gates.append((s, g)), tcs.append(tc)
    fwd = np.stack([v[0] for v in hs[1:]], 1)
    bwd = np.stack([v[1] for v in hs[:0:-1]], 1)
    e = fwd @ net.we[0] + bwd @ net.we[1] + net.be
    k = TAGS
    alpha, beta = np.zeros((top, n, k), np.float32), np.zeros((top, n, k), np.float32)
    step = np.exp(net.trans)
    alpha[0] = e[:, 0]
    for t in range(1, top):
        m = alpha[t - 1].max(1, keepdims=True)
        alpha[t] = np.log(np.exp(alpha[t - 1] - m) @ step + 1e-30) + m + e[:, t]
    for t in range(top - 2, -1, -1):
        v = beta[t + 1] + e[:, t + 1]
        m = v.max(1, keepdims=True)
        beta[t] = np.log(np.exp(v - m) @ step.T + 1e-30) + m
    m = alpha[-1].max(1, keepdims=True)
    logz = (np.log(np.exp(alpha[-1] - m).sum(1, keepdims=True)) + m)[:, 0]
    p = np.exp(alpha + beta - logz[None, :, None])
    one = np.eye(k, dtype=np.float32)[y]
    gold = (e * one).sum((1, 2)) + net.trans[y[:, :-1], y[:, 1:]].sum(1)
    loss = float((logz - gold).mean())
    de = ((p.transpose(1, 0, 2) - one) / n).astype(np.float32)
    # expected transitions, all places at once: exp(alpha + trans + e + beta - logz)
    left = np.exp(alpha[:-1] - alpha[:-1].max(2, keepdims=True))
    right_log = e.transpose(1, 0, 2)[1:] + beta[1:] + alpha[:-1].max(2, keepdims=True) - logz[None, :, None]
    dtrans = np.einsum("tni,tnj->ij", left, np.exp(np.minimum(right_log, 60))) * step
    np.add.at(dtrans, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
    grad = {"trans": (dtrans / n).astype(np.float32), "be": de.sum((0, 1)), "we": np.stack([np.einsum("nth,ntk->hk", fwd, de), np.einsum("nth,ntk->hk", bwd, de)])}
    dh_out = np.stack([de @ net.we[0].T, (de @ net.we[1].T)[:, ::-1]])
    dwh, db = np.zeros_like(net.wh), np.zeros_like(net.b)
    dzs = np.empty((2, top, n, 4 * HIDDEN), np.float32)
    dh, dc = np.zeros_like(h), np.zeros_like(h)
    for t in range(top - 1, -1, -1):
        s, g = gates[t]
        i, f, o = s[:, :, :HIDDEN], s[:, :, HIDDEN : 2 * HIDDEN], s[:, :, 2 * HIDDEN :]
        dh = dh + dh_out[:, :, t]
        dc = dc + dh * o * (1 - tcs[t] ** 2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * cs[t] * f * (1 - f), dh * tcs[t] * o * (1 - o), dc * i * (1 - g * g)], 2)
        dzs[:, t] = dz
        dwh += np.matmul(hs[t].transpose(0, 2, 1), dz)
        db += dz.sum(1, keepdims=True)
        dh = np.matmul(dz, net.wh.transpose(0, 2, 1))
        dc = dc * f
    # by character: sum of dz of all places with that character
    dwx, dembed = np.zeros_like(net.wx), np.zeros_like(net.embed)
    for d in (0, 1):
        flat, ids = dzs[d].reshape(-1, 4 * HIDDEN), xs[d].T.ravel()
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) > 0]))
        total = np.add.reduceat(flat[order], first, 0)
        who = ids[order][first]
        dwx[d] = net.embed[who].T @ total
        dembed[who] += total @ net.wx[d].T
    return loss, grad | {"embed": dembed, "wx": dwx, "wh": dwh, "b": db}


def _share(args: tuple) -> tuple[float, dict[str, np.ndarray]]:
    weights, background, seed, size = args
    net = Net(weights=weights)
    return gradient(net, *spans_by_rule(size, background, seed))


def train(background: list[str], steps: int = 3000, batch: int = 64, seed: int = 5, workers: int = 1, rate: float = 0.012, say=None) -> Net:
    """Adam with a falling rate; every batch is written anew, `workers` batches a step side by side."""
    net = Net()
    m = {k: np.zeros_like(getattr(net, k)) for k in Net.NAMES}
    v = {k: np.zeros_like(getattr(net, k)) for k in Net.NAMES}

    def shares() -> Iterator[list[tuple[float, dict[str, np.ndarray]]]]:
        jobs = lambda step: [(net.weights(), background, seed * 1_000_003 + step * workers + w, batch) for w in range(workers)]
        if workers == 1:
            for step in range(steps):
                yield [_share(jobs(step)[0])]
            return
        from multiprocessing import get_context

        with get_context("fork").Pool(workers) as pool:
            for step in range(steps):
                yield pool.map(_share, jobs(step), 1)

    for step, got in enumerate(shares()):
        grad = {k: sum(g[k] for _, g in got) / len(got) for k in Net.NAMES}
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        lr = rate * min(1.0, (steps - step) / (0.7 * steps)) + 1e-4
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.995 * v[k] + 0.005 * g * g
            setattr(net, k, (getattr(net, k) - lr * (m[k] / (1 - 0.9 ** (step + 1))) / (np.sqrt(v[k] / (1 - 0.995 ** (step + 1))) + 1e-7)).astype(np.float32))
        if say and step % 100 == 0:
            say(f"{step} {sum(x for x, _ in got) / len(got):.3f}")
    return net


def accuracy(net: Net, background: list[str], n: int = 1000, seed: int = 987_654) -> dict[str, float]:
    """Share of characters decoded right on held-out windows, of all and of each kind."""
    x, y = spans_by_rule(n, background, seed)
    got = net.decode(x, np.full(n, x.shape[1]))
    return {"all": float((got == y).mean())} | {k: float((got == y)[y == i + 1].mean()) for i, k in enumerate(KINDS)}


def main() -> None:
    import time

    import pyarrow.parquet as pq

    p = argparse.ArgumentParser()
    p.add_argument("--samples", required=True)
    p.add_argument("--steps", type=int, default=14_000)
    p.add_argument("--batch", type=int, default=64)
    p.add_argument("--workers", type=int, default=6)
    p.add_argument("--out", default=str(WEIGHTS))
    a = p.parse_args()
    background = sorted(s for s in pq.read_table(a.samples, columns=["sample"]).column(0).to_pylist() if s)
    began = time.time()
    net = train(background, a.steps, a.batch, workers=a.workers, say=lambda s: print(s, round(time.time() - began), flush=True))
    net.save(a.out)
    print(accuracy(net, background))


if __name__ == "__main__":
    main()
