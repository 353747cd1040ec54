"""(form, lemma) pairs from which suffix rules are induced (T5).

Fixed values: common inflections of English, Ukrainian and German with their dictionary forms, per language "form lemma, ...".
A product table with more pairs takes their place as a DataFrame (lang, form, lemma).
"""

from __future__ import annotations

PAIRS = {
    "en": "attacks attack, drones drone, hours hour, cities city, countries country, armies army, losses loss, classes class, "
          "boxes box, dishes dish, watches watch, reported report, attacked attack, moved move, used use, planned plan, "
          "carried carry, applied apply, wanted want, reporting report, moving move, making make, planning plan, going go, "
          "hearing hear, larger large, strongest strong, quickly quick, easily easy, nations nation, stations station, "
          "went go, was be, were be, children child, men man, said say, made make, glass glass, news news, bus bus, this this, "
          "thing thing, morning morning, bring bring, red red, need need",
    "uk": "міста місто, містом місто, містах місто, містами місто, області область, областей область, областю область, "
          "дрони дрон, дронів дрон, дронам дрон, дронами дрон, ракети ракета, ракету ракета, ракетою ракета, ракетами ракета, "
          "тривоги тривога, тривогу тривога, тривозі тривога, вибухи вибух, вибухів вибух, вибухами вибух, сили сила, "
          "силами сила, силу сила, повітряна повітряний, повітряної повітряний, повітряну повітряний, повітряні повітряний, "
          "повітряних повітряний, летить летіти, летять летіти, летіли летіти, працює працювати, працюють працювати, "
          "працювала працювати, працював працювати, оголошено оголосити, люди людина, людей людина, людям людина, "
          "є бути, був бути, була бути, було бути, були бути",
    "de": "städte stadt, länder land, kinder kind, bilder bild, frauen frau, zeitungen zeitung, meldungen meldung, tage tag, "
          "häuser haus, berichte bericht, berichten bericht, gesagt sagen, gemacht machen, sagte sagen, machte machen, "
          "sagten sagen, ging gehen, war sein, ist sein, sind sein, große groß, großen groß, großer groß, kleine klein, "
          "kleinen klein, kleines klein, zeitung zeitung, meldung meldung, und und, von von",
}


def pairs() -> list[tuple[str, str, str]]:
    """(lang, form, lemma) of :data:`PAIRS`."""
    return [(lang, *pair.split()) for lang, text in PAIRS.items() for pair in text.split(", ")]
