"""Word lists of the relevance model. Fixed values; patterns run on folded text, so they carry no accents."""

from __future__ import annotations

# Categories in order of precedence.
CATEGORIES: dict[str, list[str]] = {
    "concierto": [r"\bconcierto\b", r"\brecital\b", r"\bshow en vivo\b", r"\btocada\b", r"\bgira\b", r"\btour\b", r"\bmusica en vivo\b", r"\ben vivo\b", r"\bbanda\b", r"\bdj\b", r"\bset\b", r"\bunplugged\b", r"\bacustico\b", r"\blanzamiento de disco\b", r"\bpresentacion musical\b"],
    "festival": [r"\bfestival\b", r"\bfest\b", r"\bencuentro de\b", r"\bfestividad\b", r"\bcarnaval\b", r"\bentrada folklorica\b", r"\bcorso\b", r"\bfiesta patronal\b", r"\bmegafestival\b"],
    "feria": [r"\bferia\b", r"\bexpo\b", r"\bexposicion comercial\b", r"\bexpoferia\b", r"\bferia del libro\b", r"\bferia gastronomica\b", r"\brueda de negocios\b", r"\bmercado de\b", r"\bbazar\b", r"\bemprendedor"],
    "teatro": [r"\bteatro\b", r"\bobra de teatro\b", r"\bmonologo\b", r"\bcomedia\b", r"\bstand ?up\b", r"\bpuesta en escena\b", r"\belenco\b", r"\bfuncion\b", r"\bdramaturgia\b", r"\bimprovisacion teatral\b"],
    "danza": [r"\bdanza\b", r"\bballet\b", r"\bbaile\b", r"\bcoreografia\b", r"\bfolklorico\b", r"\bfolclorico\b", r"\bsalsa\b", r"\bbachata\b", r"\btango\b", r"\bcontemporanea\b"],
    "deporte": [r"\bpartido\b", r"\bcampeonato\b", r"\btorneo\b", r"\bmaraton\b", r"\bcarrera\b", r"\bcopa\b", r"\bliga\b", r"\bclasico\b", r"\bciclismo\b", r"\bautomovilismo\b", r"\brally\b", r"\bbox\b", r"\bmma\b", r"\bfutsal\b", r"\bvoley\b", r"\bbasquet\b"],
    "gastronomia": [r"\bgastronomic", r"\bdegustacion\b", r"\bcata\b", r"\bfood\b", r"\bcerveza artesanal\b", r"\bvino\b", r"\bsingani\b", r"\bchef\b", r"\bculinari", r"\bplato\b", r"\bcocina\b", r"\bbrunch\b"],
    "cine": [r"\bcine\b", r"\bpelicula\b", r"\bcortometraje\b", r"\bdocumental\b", r"\bproyeccion\b", r"\bestreno\b", r"\bcineclub\b", r"\bfilme\b"],
    "exposicion": [r"\bexposicion\b", r"\bmuestra\b", r"\bgaleria\b", r"\bvernissage\b", r"\binauguracion de la muestra\b", r"\bcoleccion\b", r"\bretrospectiva\b", r"\bartes visuales\b", r"\bfotografia\b", r"\bpintura\b", r"\bescultura\b"],
    "literatura": [r"\bliterari[oa]\b", r"\bclub de lectura\b", r"\blecturas?\b", r"\bpoesia\b", r"\bpoeta\b", r"\bpresentacion de (?:un )?libro\b", r"\bencuentro de escritores\b", r"\bbiblioteca\b"],
    "turismo": [r"\bturistic[oa]\b", r"\bturismo\b", r"\bvisita guiada\b", r"\brecorrido guiado\b", r"\bruta cultural\b", r"\bruta patrimonial\b", r"\bpatrimonio (?:historico|cultural)\b"],
    "conferencia": [r"\bconferencia\b", r"\bcongreso\b", r"\bseminario\b", r"\bsimposio\b", r"\bforo\b", r"\bpanel\b", r"\bcharla\b", r"\bdisertacion\b", r"\bconversatorio\b", r"\bjornada\b", r"\bsummit\b", r"\bmeetup\b"],
    "taller": [r"\btaller\b", r"\bcurso\b", r"\bcapacitacion\b", r"\bworkshop\b", r"\bdiplomado\b", r"\bmasterclass\b", r"\bclase magistral\b", r"\bentrenamiento\b", r"\bbootcamp\b", r"\binscripciones abiertas\b"],
    "infantil": [r"\binfantil\b", r"\bpara ninos\b", r"\bninos y ninas\b", r"\btiteres\b", r"\bcuentacuentos\b", r"\bkids\b", r"\bvacacion(?:es)? util(?:es)?\b", r"\bfamiliar\b"],
    "religioso": [r"\bmisa\b", r"\bprocesion\b", r"\bnovena\b", r"\bperegrinacion\b", r"\bpascua\b", r"\bvigilia de oracion\b", r"\bculto\b", r"\bretiro espiritual\b"],
    "nightlife": [r"\bfiesta\b", r"\bafter\b", r"\bdiscoteca\b", r"\bparty\b", r"\bnoche de\b", r"\bopen bar\b", r"\bpre[- ]?fiesta\b", r"\brumba\b"],
    "moda": [r"\bdesfile de moda\b", r"\bpasarela\b", r"\bfashion\b", r"\bmodelaje\b"],
    "tecnologia": [r"\bhackathon\b", r"\btecnologia\b", r"\bstartup\b", r"\bgaming\b", r"\besports\b", r"\be-sports\b", r"\brobotica\b", r"\binteligencia artificial\b"],
}

# Phrases that announce.
CALLS = [r"\bte esperamos\b", r"\bno te lo pierdas\b", r"\bno faltes\b", r"\bse parte\b", r"\bacompananos\b", r"\bnos vemos\b", r"\bpreparate\b", r"\breserva (?:tu|la) fecha\b", r"\bsave the date\b", r"\bya vienen?\b", r"\bproximamente\b", r"\bvuelve\b", r"\bllega\b", r"\bpresentamos\b", r"\bse viene\b", r"\bagenda\b", r"\banuncia", r"\bcompra tus entradas\b", r"\badquiere tus entradas\b", r"\binscribete\b", r"\bregistrate\b", r"\bcupos limitados\b", r"\bultimas entradas\b"]

# Phrases of what is over.
PAST = [r"\bse realizo\b", r"\bse llevo a cabo\b", r"\bse desarrollo\b", r"\btuvo lugar\b", r"\bfue inaugurad", r"\bcerro sus puertas\b", r"\bculmino\b", r"\bfinalizo\b", r"\bconcluyo\b", r"\bgracias a todos\b", r"\bgracias por acompanarnos\b", r"\bfue un exito\b", r"\basi se vivio\b", r"\brevive\b", r"\bresumen de\b", r"\bbalance de\b", r"\bel pasado\b", r"\banoche\b", r"\bayer\b", r"\bla noche del\b", r"\bse presento\b", r"\brecibio a\b", r"\bganador(?:es)? de\b", r"\bpremiacion de la pasada\b"]

# Topics that are no events.
OFF_TOPIC = [r"\bfallecimiento\b", r"\bcondolencias\b", r"\bsentido pesame\b", r"\bconvocatoria (?:publica )?(?:de|para) (?:contratacion|personal)\b", r"\bofert[ao] laboral\b", r"\bempleo\b", r"\bcurriculum\b", r"\blicitacion\b", r"\bcomunicado de prensa sobre\b", r"\bhoroscopo\b", r"\bsorteo de\b", r"\bpromocion valida\b", r"\bdescuento en\b", r"\bcredito\b", r"\bprestamo\b", r"\bseguro\b", r"\btarifa\b", r"\bcorte de agua\b", r"\bcorte de luz\b", r"\bbloqueo\b", r"\bparo\b", r"\bmarcha de protesta\b", r"\baccidente\b", r"\bdetenido\b", r"\baprehendid", r"\bhurto\b", r"\brobo\b"]

# States in order of precedence, and outlets by name.
STATES = {
    "cancelado": [r"\bcancelad", r"\bsuspendid", r"\bse cancela\b", r"\bqueda sin efecto\b"],
    "postergado": [r"\bposterga", r"\breprograma", r"\bnueva fecha\b", r"\baplaza"],
    "agotado": [r"\bagotad", r"\bsold ?out\b", r"\bentradas agotadas\b", r"\bno hay entradas\b"],
}
OUTLETS = {
    "Farmacorp": r"\bfarmacorp\b", "SuperTicket": r"\bsuper ?ticket\b", "Ticket.bo": r"\bticket\.bo\b", "Tu Entrada": r"\btu entrada\b",
    "Passline": r"\bpassline\b", "Ticketeg": r"\bticketeg\b", "Boletería": r"\bboleteria\b", "Puntos de venta": r"\bpuntos? de venta\b",
    "Preventa": r"\bpreventa\b", "Venta en puerta": r"\ben puerta\b",
}
TICKET_DOMAINS = ("superticket.bo", "ticket.bo", "tuentrada.com.bo", "passlinebolivia.com", "passline.com", "ticketeg.com", "eventbrite.com", "bandsintown.com", "fexpocruz.com.bo", "entradas")

# Months and weekdays as posters write them.
MONTHS = {
    "enero": 1, "ene": 1, "febrero": 2, "feb": 2, "marzo": 3, "mar": 3, "abril": 4, "abr": 4, "mayo": 5, "may": 5, "junio": 6, "jun": 6,
    "julio": 7, "jul": 7, "agosto": 8, "ago": 8, "agost": 8, "septiembre": 9, "setiembre": 9, "sep": 9, "sept": 9, "set": 9,
    "octubre": 10, "oct": 10, "noviembre": 11, "nov": 11, "diciembre": 12, "dic": 12,
}
WEEKDAYS = {"lunes": 0, "martes": 1, "miercoles": 2, "jueves": 3, "viernes": 4, "sabado": 5, "domingo": 6}
