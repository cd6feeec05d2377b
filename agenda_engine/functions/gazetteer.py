"""Known places. Fixed values; names as shown, aliases as they stand in folded text."""

from __future__ import annotations

# Departments, and names that tell the department.
DEPARTMENTS = ("La Paz", "Cochabamba", "Santa Cruz", "Oruro", "Potosí", "Chuquisaca", "Tarija", "Beni", "Pando")
DEPARTMENT_ALIASES: dict[str, tuple[str, ...]] = {
    "La Paz": (
        "la paz", "el alto", "chuquiago", "sopocachi", "miraflores", "calacoto", "san miguel", "obrajes", "zona sur", "achumani", "irpavi", "villa fatima",
        "el prado", "san pedro", "cota cota", "mallasa", "viacha", "achocalla", "copacabana", "coroico", "chulumani", "caranavi", "yungas", "tiwanaku",
        "sorata", "patacamaya", "desaguadero", "guaqui", "batallas",
    ),
    "Cochabamba": (
        "cochabamba", "llajta", "cercado", "sacaba", "quillacollo", "tiquipaya", "colcapirhua", "vinto", "sipe sipe", "villa tunari", "chapare", "punata",
        "cliza", "mizque", "tarata", "aiquile", "totora", "tiraque", "colomi", "el prado cochabamba", "recoleta", "queru queru", "tupuraya", "sarco",
        "muyurina", "america", "hipodromo",
    ),
    "Santa Cruz": (
        "santa cruz", "santa cruz de la sierra", "equipetrol", "urubo", "plan 3000", "villa 1ro de mayo", "pampa de la isla", "el torno", "la guardia", "cotoca",
        "warnes", "montero", "porongo", "buena vista", "samaipata", "vallegrande", "camiri", "san ignacio de velasco", "san jose de chiquitos", "concepcion",
        "roboré", "robore", "yapacani", "portachuelo", "mineros", "san julian", "guarayos", "ascension",
    ),
    "Oruro": ("oruro", "huanuni", "challapata", "caracollo", "poopo", "sabaya", "curahuara", "totora oruro", "av. civica", "avenida civica"),
    "Potosí": ("potosi", "villa imperial", "uyuni", "llallagua", "tupiza", "villazon", "cerro rico", "colquechaca", "betanzos", "cotagaita", "atocha"),
    "Chuquisaca": ("sucre", "chuquisaca", "ciudad blanca", "monteagudo", "camargo", "villa serrano", "padilla", "zudanez", "yotala", "tarabuco"),
    "Tarija": ("tarija", "yacuiba", "bermejo", "villamontes", "villa montes", "entre rios tarija", "san lorenzo tarija", "el valle de la concepcion", "uriondo", "padcaya"),
    "Beni": ("beni", "trinidad", "riberalta", "guayaramerin", "rurrenabaque", "san borja", "santa ana del yacuma", "san ignacio de moxos", "reyes"),
    "Pando": ("pando", "cobija", "porvenir", "puerto rico", "filadelfia", "bella flor"),
}
# Cities with their aliases and department.
CITIES: dict[str, tuple[tuple[str, ...], str]] = {
    "La Paz": (("ciudad de la paz", "la paz", "chuquiago"), "La Paz"),
    "El Alto": (("el alto", "ciudad de el alto"), "La Paz"),
    "Cochabamba": (("ciudad de cochabamba", "cochabamba", "llajta"), "Cochabamba"),
    "Sacaba": (("sacaba",), "Cochabamba"),
    "Quillacollo": (("quillacollo",), "Cochabamba"),
    "Tiquipaya": (("tiquipaya",), "Cochabamba"),
    "Santa Cruz de la Sierra": (("santa cruz de la sierra", "ciudad de santa cruz", "santa cruz"), "Santa Cruz"),
    "Montero": (("montero",), "Santa Cruz"),
    "Warnes": (("warnes",), "Santa Cruz"),
    "La Guardia": (("la guardia",), "Santa Cruz"),
    "Cotoca": (("cotoca",), "Santa Cruz"),
    "Oruro": (("ciudad de oruro", "oruro"), "Oruro"),
    "Potosí": (("ciudad de potosi", "potosi", "villa imperial"), "Potosí"),
    "Uyuni": (("uyuni",), "Potosí"),
    "Sucre": (("ciudad de sucre", "sucre", "ciudad blanca"), "Chuquisaca"),
    "Tarija": (("ciudad de tarija", "tarija"), "Tarija"),
    "Yacuiba": (("yacuiba",), "Tarija"),
    "Trinidad": (("ciudad de trinidad", "trinidad"), "Beni"),
    "Riberalta": (("riberalta",), "Beni"),
    "Cobija": (("cobija",), "Pando"),
}
# Venues with their aliases, city and department.
VENUES: dict[str, tuple[tuple[str, ...], str, str]] = {
    "Teatro Municipal Alberto Saavedra Pérez": (("teatro municipal alberto saavedra", "teatro municipal de la paz"), "La Paz", "La Paz"),
    "Teatro al Aire Libre Jaime Laredo": (("teatro al aire libre", "jaime laredo", "aire libre jaime laredo"), "La Paz", "La Paz"),
    "Cine Teatro Municipal 6 de Agosto": (("cine teatro municipal 6 de agosto", "teatro 6 de agosto"), "La Paz", "La Paz"),
    "Teatro Modesta Sanjinés": (("modesta sanjines",), "La Paz", "La Paz"),
    "Teatro Nuna": (("teatro nuna",), "La Paz", "La Paz"),
    "Coliseo Julio Borelli Viterito": (("julio borelli", "coliseo cerrado julio borelli", "coliseo borelli"), "La Paz", "La Paz"),
    "Estadio Hernando Siles": (("hernando siles",), "La Paz", "La Paz"),
    "Casa de la Cultura Franz Tamayo": (("casa de la cultura franz tamayo", "casa de la cultura de la paz"), "La Paz", "La Paz"),
    "Espacio Simón I. Patiño La Paz": (("espacio simon i. patino", "espacio simon patino"), "La Paz", "La Paz"),
    "Centro Cultural de España en La Paz": (("centro cultural de espana en la paz", "ccelp"), "La Paz", "La Paz"),
    "Museo Nacional de Arte": (("museo nacional de arte",), "La Paz", "La Paz"),
    "Parque Urbano Central": (("parque urbano central", "puc la paz"), "La Paz", "La Paz"),
    "Multicine La Paz": (("multicine",), "La Paz", "La Paz"),
    "Megacenter La Paz": (("megacenter",), "La Paz", "La Paz"),
    "Coliseo Cerrado de El Alto": (("coliseo cerrado de el alto", "coliseo de el alto"), "El Alto", "La Paz"),
    "Teatro Achá": (("teatro acha", "teatro jose maria acha", "teatro jose maria de acha"), "Cochabamba", "Cochabamba"),
    "Estadio Félix Capriles": (("felix capriles",), "Cochabamba", "Cochabamba"),
    "Coliseo Evo Morales": (("coliseo evo morales", "coliseo cerrado de cochabamba"), "Cochabamba", "Cochabamba"),
    "Centro Pedagógico y Cultural Simón I. Patiño": (("centro pedagogico y cultural simon i. patino", "palacio portales", "centro simon patino"), "Cochabamba", "Cochabamba"),
    "mARTadero": (("martadero", "el martadero"), "Cochabamba", "Cochabamba"),
    "Casa de la Cultura Cochabamba": (("casa de la cultura de cochabamba",), "Cochabamba", "Cochabamba"),
    "Cine Center Cochabamba": (("cine center",), "Cochabamba", "Cochabamba"),
    "Fexpocruz": (("fexpocruz", "campo ferial fexpocruz", "expocruz", "recinto ferial fexpocruz"), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Estadio Ramón Tahuichi Aguilera": (("tahuichi aguilera", "estadio tahuichi"), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Coliseo Don Bosco": (("don bosco",), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Casa de la Cultura Raúl Otero Reiche": (("casa de la cultura raul otero reiche", "casa de la cultura de santa cruz"), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Manzana Uno Espacio de Arte": (("manzana uno", "manzana 1"), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Centro de Convenciones Sirionó": (("siriono", "centro de convenciones siriono"), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Ventura Mall": (("ventura mall",), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Cine Center Santa Cruz": (("cine center santa cruz",), "Santa Cruz de la Sierra", "Santa Cruz"),
    "Teatro Gran Mariscal Sucre": (("gran mariscal sucre", "teatro gran mariscal"), "Sucre", "Chuquisaca"),
    "Casa de la Libertad": (("casa de la libertad",), "Sucre", "Chuquisaca"),
    "Estadio Patria": (("estadio patria",), "Sucre", "Chuquisaca"),
    "Casa Dorada": (("casa dorada",), "Tarija", "Tarija"),
    "Estadio IV Centenario": (("iv centenario", "cuarto centenario"), "Tarija", "Tarija"),
    "Avenida Cívica Oruro": (("avenida civica", "av. civica"), "Oruro", "Oruro"),
    "Teatro Palais Concert": (("palais concert",), "Oruro", "Oruro"),
    "Casa Nacional de Moneda": (("casa nacional de moneda", "casa de la moneda"), "Potosí", "Potosí"),
}
# A kind of venue with a name behind it, and a street address, in texts as they are written.
_NAMED = r"[\wÁÉÍÓÚÑáéíóúñ'’.-]*"
VENUE_PATTERN = (
    r"(?U)\b(?:teatro|coliseo|estadio|auditorio|auditorium|sal[oó]n|salon de eventos|casa de la cultura|centro cultural|centro de convenciones|campo ferial"
    r"|predio ferial|anfiteatro|paraninfo|plaza|parque|club|caf[eé] cultural|pe[ñn]a|discoteca|complejo|polideportivo|cancha|galer[ií]a|museo)"
    rf"\s+[A-ZÁÉÍÓÚÑ0-9]{_NAMED}(?:\s+(?:de|del|la|el|los|las|y)\s+|\s+)?(?:[A-ZÁÉÍÓÚÑ0-9]{_NAMED})?(?:\s+[A-ZÁÉÍÓÚÑ]{_NAMED})?"
)
ADDRESS_PATTERN = r"(?iU)\b(?:av\.?|avenida|calle|c\.|esq\.?|esquina|zona|barrio|km\.?|kil[oó]metro|anillo|radial|pasaje)\s+[^\n,;|]{3,70}"
COUNTRY = "Bolivia"
