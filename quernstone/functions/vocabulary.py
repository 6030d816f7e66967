"""Rule tables. All literals here are fixed values: results depend on them exactly."""

from __future__ import annotations

# Classes that say nothing specific.
GENERIC_TYPES = ["Unknown", "Place", "Organization", "Service", "Concept", "Accommodation"]
FORBIDDEN_TYPES = ["Thing", "Entity", "Item", "Location"]
GENERIC_FINAL_CLASSES = ["Unknown", "Place", "Concept", "SIN_TIPO", "ContentPage", "CategoryPage"]
NON_FINAL_CLASSES = ["Unknown", "Concept", "ContentPage", "CategoryPage"]

# Classes whose name identifies an entity on every page.
CROSS_PAGE_CLASSES = [
    "TownHall", "Cathedral", "Church", "Chapel", "Basilica", "Palace", "Castle", "Museum", "Square", "Garden", "Bridge", "Wall",
    "TraditionalMarket", "Monastery", "Convent", "Theater", "Theatre", "Hotel", "Hostel", "Route", "Event", "Monument",
]

# Priority of a class among an entity's candidates; 50 for any other.
TYPE_PRIORITY = {
    "Hotel": 100, "Hostel": 100, "Accommodation": 80, "Restaurant": 100, "FoodEstablishment": 90, "Cafe": 90, "Bar": 90, "Museum": 100,
    "Airport": 100, "TouristAttraction": 95, "Monument": 92, "Castle": 95, "Basilica": 95, "Cathedral": 95, "Church": 95, "Chapel": 90,
    "Monastery": 94, "Palace": 94, "Square": 88, "TownHall": 92, "Park": 92, "Garden": 90, "Bridge": 94, "Street": 82, "Market": 88,
    "Theatre": 92, "Arena": 92, "SportsVenue": 92, "Fortification": 92, "Gate": 88, "ArcheologicalSite": 90,
    "HistoricalOrCulturalResource": 70, "Event": 92, "ExhibitionHall": 88, "Activity": 82, "Route": 84, "Excursion": 88, "GuidedTour": 86,
    "TourismService": 82, "EventOrganisationCompany": 60, "Dish": 90, "Dessert": 90, "Drink": 88, "FoodProduct": 88, "ContentPage": 5,
    "CategoryPage": 5, "Organization": 10, "Service": 20, "Place": 5, "Concept": 0, "Unknown": 0,
}

# Spellings of classes.
CANONICAL_TYPES = {
    "hotel": "Hotel", "hotels": "Hotel", "hostel": "Hostel", "hostels": "Hostel", "albergue": "Hostel", "albergues": "Hostel",
    "lodging": "Accommodation", "accommodation": "Accommodation", "restaurant": "Restaurant", "restaurants": "Restaurant",
    "foodestablishment": "FoodEstablishment", "museum": "Museum", "museums": "Museum", "airport": "Airport", "airports": "Airport",
    "bar": "Bar", "bars": "Bar", "cafe": "Cafe", "cafes": "Cafe", "coffee shop": "Cafe", "tourist attraction": "TouristAttraction",
    "touristattraction": "TouristAttraction", "attraction": "TouristAttraction",
    "historicalorculturalresource": "HistoricalOrCulturalResource", "archeologicalsite": "ArcheologicalSite",
    "archaeologicalsite": "ArcheologicalSite", "eventorganisationcompany": "EventOrganisationCompany", "townhall": "TownHall",
    "exhibitionhall": "ExhibitionHall", "park": "Park", "garden": "Garden", "bridge": "Bridge", "church": "Church",
    "monastery": "Monastery", "palace": "Palace", "market": "Market", "theatre": "Theatre", "theater": "Theatre", "arena": "Arena",
    "sportsvenue": "SportsVenue", "fortification": "Fortification", "gate": "Gate", "street": "Street", "route": "Route",
    "excursion": "Excursion", "activity": "Activity", "guidedtour": "GuidedTour", "tourismservice": "TourismService", "dish": "Dish",
    "dessert": "Dessert", "drink": "Drink", "foodproduct": "FoodProduct", "contentpage": "ContentPage", "categorypage": "CategoryPage",
}

# Fixed values: (words, class) that rescue a generic entity; the first that a text holds decides.
RESCUE_RULES = [
    (["cathedral", "catedral"], "Cathedral"), (["basilica", "basílica"], "Basilica"), (["iglesia", "church"], "Church"),
    (["monasterio", "monastery"], "Monastery"), (["museum", "museo"], "Museum"), (["castle", "castillo"], "Castle"),
    (["alcazar", "alcázar"], "Alcazar"), (["chapel", "capilla"], "Chapel"), (["plaza", "square"], "Square"),
    (["town hall", "ayuntamiento"], "TownHall"), (["parque", "park"], "Park"), (["jardines", "garden"], "Garden"),
    (["puente", "bridge"], "Bridge"), (["palacio", "palace"], "Palace"), (["mercado", "market"], "Market"),
    (["teatro", "theatre", "theater"], "Theatre"), (["arena"], "Arena"), (["fronton", "frontón"], "SportsVenue"),
    (["murallas", "fortification"], "Fortification"), (["portal"], "Gate"),
    (["restaurant", "restaurante", "bar", "cafeteria", "cafetería"], "FoodEstablishment"), (["event", "evento", "festival"], "Event"),
    (["excursion", "excursión"], "Excursion"), (["ruta", "route"], "Route"), (["senderismo", "cicloturismo", "activity"], "Activity"),
    (["bureau", "incoming", "guias", "guías", "servicio", "service"], "TourismService"), (["postre"], "Dessert"),
    (["licor", "sidra", "drink"], "Drink"), (["queso", "food product"], "FoodProduct"),
    (["goxua", "cuajada", "pantxineta", "ajoarriero", "fritos"], "Dish"),
]

# Families by words, in order.
FAMILY_KEYWORDS = {
    "food_drink": ["postre", "dessert", "queso", "cheese", "licor", "sidra", "drink", "patxaran", "bacalao", "goxua", "pantxineta", "cuajada", "ajoarriero", "fritos", "menestra", "pochas"],
    "event": ["festival", "evento", "event", "vinofest", "concierto", "gira", "exposición", "exposicion"],
    "route_experience": ["ruta", "route", "excursión", "excursion", "senderismo", "cicloturismo", "visita guiada", "guided tour", "camino", "tour"],
    "organization_service": ["bureau", "incoming", "guías", "guias", "profesional", "service", "servicio", "convention bureau", "tourism service"],
    "place": [
        "parque", "park", "jardines", "garden", "puente", "bridge", "frontón", "fronton", "palacio", "palace", "portal", "murallas",
        "mercado", "market", "arena", "teatro", "theatre", "iglesia", "church", "monasterio", "cathedral", "catedral", "basilica",
        "basílica", "plaza", "ayuntamiento", "museo", "museum", "castillo", "alcázar", "alcazar",
    ],
    "content_page": ["blog", "categorías", "categorias", "todos los lugares", "planifica tu viaje"],
}

# Page types by a part of the URL, in order.
PAGE_TYPES = [
    ("place_detail", ["/lugar/"]), ("event_detail", ["/evento/"]), ("listing_page", ["/lugares/page/"]),
    ("category_page", ["/tipo-lugar/", "/category/"]), ("blog_page", ["/blog"]),
    ("professional_page", ["/profesional", "/eventos-del-sector", "/area-profesional/"]),
]
STRICT_PAGE_TYPES = ["listing_page", "category_page", "blog_page", "professional_page"]

# Classes that stand at a place.
PHYSICAL_CLASSES = [
    "Airport", "ArcheologicalSite", "Bar", "Basilica", "Bridge", "Camping", "Castle", "Cathedral", "Chapel", "Church", "Convent", "Garden",
    "Gate", "HistoricalOrCulturalResource", "Hostel", "Hotel", "Monastery", "Monument", "Museum", "Palace", "Park", "Restaurant", "Square",
    "Theatre", "Theater", "TownHall", "TraditionalMarket", "Wall",
]

# Wrongly decoded letters, replaced in order.
MOJIBAKE = [
    ("Ç?", "Á"), ("Ç­", "á"), ("Ç¸", "é"), ("Çð", "í"), ("Çü", "ó"), ("Ç§", "ú"), ("Çñ", "ñ"), ("ƒ-¬", ""), ("ƒ?o", '"'), ("ƒ??", '"'),
    ("ƒ?", '"'), ("Â¿", "¿"), ("Â¡", "¡"), ("Â«", '"'), ("Â»", '"'), ("Âº", "º"), ("Âª", "ª"), ("Â", ""),
]

# Evidence weights of words in a name and in its context, and fragments that speak against it.
EVIDENCE_NAME = {
    "ayuntamiento": 3.0, "catedral": 3.0, "iglesia": 2.5, "capilla": 2.5, "monasterio": 2.5, "convento": 2.5, "palacio": 2.5, "castillo": 2.5,
    "puente": 2.0, "plaza": 2.0, "parque": 1.5, "mercado": 1.5, "museo": 2.5, "fronton": 2.0, "frontón": 2.0, "camino de santiago": 3.0,
    "ruta": 1.5, "festival": 2.5, "san fermin": 3.0, "san fermín": 3.0,
}
EVIDENCE_CONTEXT = {
    "monumento": 1.5, "escultura": 1.5, "estatua": 1.5, "busto": 1.5, "homenaje": 1.2, "retrato": 1.2, "peregrinación": 1.5,
    "peregrinacion": 1.5, "ruta": 1.0, "patrimonio": 1.0, "turismo": 0.8, "visita": 0.8, "historia": 0.7, "cultural": 0.7, "festival": 1.0,
    "fiesta": 0.8,
}
EVIDENCE_AGAINST = [
    "ir al contenido", "todos los derechos reservados", "accesibilidad", "reserva tu actividad", "ver más", "ver mas", "mapas", "google maps",
    "compartir", "newsletter", "guías", "convention bureau", "área profesional", "area profesional",
]

# Names that are cut short, fragments of prose, and utility pages.
TRUNCATED_TAILS = [" de", " del", " la", " el", " los", " las", " y"]
TRUNCATED_HEADS = ["de ", "del ", "y "]
CONTEXT_FRAGMENTS = ["continuamos", "cruzando", "datos api", "api"]
OUT_OF_SCOPE = ["madrid"]
UTILITY_NAMES = ["contacta con nosotros", "contacto", "informacion practica", "información práctica", "burgos centro", "planifica tu viaje", "que hacer", "qué hacer", "que ver", "qué ver"]
ANCHOR_WORDS = ["archivo", "capilla", "catedral", "convento", "fuente", "hospital", "iglesia", "mercado", "monasterio", "museo", "palacio", "parque", "plaza", "puente", "ruta", "teatro"]
LEADING_CLASSES = {
    "plaza": "Square", "hotel": "Hotel", "restaurante": "Restaurant", "museo": "Museum", "catedral": "Cathedral", "iglesia": "Church",
    "palacio": "Palace", "ayuntamiento": "TownHall", "jardines": "Garden", "parque": "Garden", "puente": "Bridge",
}

# Priority of a class when records of one entity are merged.
MERGE_PRIORITY = {
    "Alcazar": 100, "Cathedral": 98, "Basilica": 96, "Chapel": 95, "Church": 94, "Castle": 93, "ArcheologicalSite": 92, "Bullring": 91,
    "TownHall": 90, "Stadium": 89, "Square": 88, "Museum": 87, "ExhibitionHall": 86, "CultureCenter": 85, "EducationalCenter": 84,
    "SportsCenter": 83, "SportFacility": 82, "TransportInfrastructure": 81, "FoodEstablishment": 80, "AccommodationEstablishment": 79,
    "Accommodation": 78, "TourismService": 77, "PublicService": 76, "EventOrganisationCompany": 75, "Event": 70, "Person": 65, "Route": 60,
    "Monument": 58, "TouristAttraction": 30, "TouristAttractionSite": 29, "TourismDestination": 20, "Place": 15, "Organization": 10,
    "LocalBusiness": 9, "Thing": 1, "Concept": 0,
}

# The taxonomy, child to parent.
PARENTS = {
    "Concept": "Thing", "Organization": "Thing", "Service": "Thing", "Place": "Thing", "Event": "Thing", "Accommodation": "Thing",
    "TouristAttraction": "Place", "TransportInfrastructure": "Place", "Square": "Place", "TownHall": "Place", "BullRing": "Place",
    "SportsCenter": "Place", "CultureCenter": "Place", "ExhibitionHall": "Place", "Stadium": "Place", "EventAttendanceFacility": "Place",
    "Museum": "TouristAttraction", "Monument": "TouristAttraction", "Castle": "TouristAttraction", "Alcazar": "TouristAttraction",
    "Basilica": "TouristAttraction", "Cathedral": "TouristAttraction", "Church": "TouristAttraction", "Chapel": "TouristAttraction",
    "ArcheologicalSite": "TouristAttraction", "HistoricalOrCulturalResource": "TouristAttraction",
    "AccommodationEstablishment": "Accommodation", "FoodEstablishment": "Service", "TourismService": "Service", "PublicService": "Service",
    "RetailAndFashion": "Service", "EducationalCenter": "Organization", "EventOrganisationCompany": "Organization",
    "DestinationExperience": "Concept",
}
GENERIC_CLASSES = ["Thing", "Place", "Organization", "Service", "Concept", "Accommodation", "EventAttendanceFacility"]
NOT_IN_ONTOLOGY = [
    "", "Unknown", "Thing", "Location", "Place", "Entity", "Item", "Concept", "ConceptScheme", "ConceptualObject", "TourismEntity",
    "TourismResource", "TourismService", "TourismOrganisation", "TourismOrRelatedFacility", "Resource", "Agent",
]

# Parts of URLs that a crawl leaves out.
BLOCKED_LANGUAGES = ["de", "en", "fr", "it", "pt", "ja", "ko", "zh", "zh-hans", "zh-hant"]
BAD_EXTENSIONS = [
    ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".pdf", ".zip", ".rar", ".7z", ".mp4", ".mp3", ".avi", ".mov", ".wmv", ".doc", ".docx",
    ".xls", ".xlsx", ".ppt", ".pptx", ".xml", ".json", ".css", ".js",
]
BAD_URL_PARTS = ["/wp-content/", "/wp-json/", "/feed", "/tag/", "/author/", "/search?", "/documents/", "/documentos/", "/o/", "/c/", "?s=", "/cdn-cgi/"]
BAD_QUERY_PARTS = ["minifiertype=css", "minifiertype=js", "themeid=", "browserid=", "languageid="]
CUT_SLUG_TAILS = ["em", "en", "os", "as", "do", "da", "de", "del", "para", "pela", "por"]

# Noise words of the evaluation's names.
EVAL_NOISE = ["compartir", "abrir", "direccion", "comprar", "donde", "google maps", "ademas", "calle"]

# Words that hide nothing of a page's content, for HTML blocks.
BLOCK_NOISE = ["menu", "nav", "header", "footer", "sidebar", "cookie", "banner", "login", "form", "search", "newsletter", "breadcrumbs", "breadcrumb", "pagination", "pager", "filter", "filters", "modal", "popup", "share", "social"]
BLOCK_UI = ["phone number", "email", "login", "register", "password", "cookies", "política de cookies", "politica de cookies", "aviso legal", "privacy policy", "política de privacidad", "politica de privacidad"]
BLOCK_CONTACT = ["teléfono", "telefono", "phone", "móvil", "movil", "email", "correo", "@", "facebook", "instagram", "x-twitter", "twitter", "linkedin", "oficinaturismo", "oficina de turismo", "plaza consistorial", "consistorial", "s/n", "cp ", "c.p.", "31001"]
BLOCK_SHORT_UI = ["ver más", "ver mas", "leer más", "leer mas", "más info", "mas info", "contacto", "inicio", "mapa", "cómo llegar", "como llegar", "llamar", "reservar", "comprar", "cerrar"]
