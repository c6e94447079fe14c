"""Data that must be exactly this for results to be right.

Nothing here is logic.  Every operator that uses one of these tables takes it
as a parameter and only falls back to the value below, so another corpus can
bring its own lists.

Word lists hold single, accent-free, lower-case words only: tokens are
accent-free single words when they are looked up, so a phrase, a hyphenated
form or an accented form could never match.
"""

from __future__ import annotations

# --- fixed values: thresholds and cut lengths -------------------------------

MIN_TITLE_LENGTH = 5
MIN_CONTENT_LENGTH = 30
MIN_SUMMARY_LENGTH = 20
MIN_DETECTABLE_LENGTH = 5
MIN_MESSAGE_LENGTH = 5
MIN_CATEGORY_WORDS = 6
MALAGASY_RATIO = 0.15
POSITIVE_ABOVE = 0.2
NEGATIVE_BELOW = -0.2
KEEP_RATIO = 0.7
MAX_CATEGORIES = 3
SIMILARITY_THRESHOLD = 0.30
ENTRIES_PER_FEED = 15
RECENT_MESSAGES = 15
SUMMARY_CHARS = 500
TITLE_CHARS = 200
MODEL_CHARS = 512
VECTOR_CHARS = 800
SHORT_ID_CHARS = 16
MAX_BAD_RECORDS = 10
DEFAULT_CATEGORY = "autre"

# --- fixed values: Malagasy words -------------------------------------------

MALAGASY_WORDS = """
izy anao aho isika ianao izany ity ireo eto any amin ao ary na fa raha satria
firenena tanora mponina sekoly mpianatra governemanta ministera depiote depute
filoha lalampanorenana repoblika kaominina prefe distrika mpitondra fitondrana
trano lalana fianakaviana asa vidimpiainana fampandrosoana fiainana vahoaka
zaza reny ray
toekarena varotra orinasa tsena banky fampiasambola hetra karama vola tetibola
fividianana fanondranana
fahasalamana hopitaly dokotera aretina vaksiny fanafody marary valanaretina
hopital
fanabeazana oniversite universite mpampianatra kilasy fampianarana
lalao ekipa fifaninanana mpilalao stadiona
haitao siansa fikajiana rindranasa aterineto tambajotra finday solosaina
toetrandro fandotoana ala rano rivodoza
ady firaisankina diplomasia
heloka fitsarana mpisolovava polisy fonja
fitaterana taxibe bus fiara sambo
vaovao gazety tatitra fanambarana lahateny
""".split()

# --- fixed values: Malagasy words of praise and of complaint ----------------

POSITIVE_WORDS = """
faly hafaliana ravoravo mientanentana fiononana finaritra tahamaina
tsara mahafinaritra mendrika mety mahatalanjona miavaka mahasoa mankasitraka
fandrosoana fampandrosoana nahomby fahombiazana fanatsarana fanarenana
fitomboana tombony fanavaozana fampivoarana fahavitrihana
fanohanana firaisankina fandriampahalemana fampanantenana
milamina filaminana voavaha vahaolana
""".split()

NEGATIVE_WORDS = """
alahelo malahelo fahoriana mampalahelo menatra harerahana mitsiriritra
ratsy manahirana sarotra olana manimba maharary mampanahy
krizy korontana fifandirana disadisa ady herisetra fanafintohina
fikorontanana fahavoazana
fatiantoka fahaverezana
mahantra fahantrana
kolikoly hosoka halatra fanararaotana
""".split()

# --- fixed values: category phrases, in category order ----------------------
CATEGORY_PHRASES = {
    "politique": [
        "président", "premier ministre", "gouvernement", "député", "sénat", "assemblée nationale",
        "élection", "campagne électorale", "parti", "opposition", "majorité", "constitution",
        "république", "mandat", "candidat", "ministre", "manifestation", "coup d etat",
        "accord politique", "transition", "concertation nationale", "coalition",
        "motion de censure", "révision constitutionnelle", "remaniement", "conseil des ministres",
        "scrutin", "bureau de vote", "liste électorale", "autorité de transition",
        "haute cour constitutionnelle", "hcc", "chef de l etat", "collectivité territoriale",
        "gouvernorat", "commune", "maire", "préfet", "décentralisation", "filoha", "governemanta",
        "ministera", "depiote", "fifidianana", "antoko politika", "lalampanorenana", "repoblika",
        "fitondrana", "mpitondra", "fanovana governemanta",
    ],
    "justice": [
        "tribunal", "juge", "procureur", "cour suprême", "justice", "avocat", "condamnation",
        "détention", "prison", "garde a vue", "incarcération", "crime", "enquête", "police",
        "gendarmerie", "plainte", "audience", "mandat d arrêt", "fraude", "corruption",
        "dossier judiciaire", "escroquerie", "trafic", "violence", "fitsarana", "mpisolovava",
        "heloka", "fanadihadiana", "polisy", "fonja",
    ],
    "économie": [
        "économie", "inflation", "croissance", "budget", "loi de finances", "finance", "banque",
        "investissement", "marché", "entreprise", "industrie", "exportation", "importation", "pib",
        "développement économique", "secteur privé", "microfinance", "subvention",
        "prix du carburant", "pouvoir d achat", "coût de la vie", "toekarena", "varotra", "orinasa",
        "tsena", "fampiasambola", "vidimpiainana", "tetibola",
    ],
    "société": [
        "population", "citoyen", "communauté", "social", "pauvreté", "emploi", "sécurité",
        "migration", "inégalité", "droits humains", "protestation", "grève", "violence urbaine",
        "insécurité", "mponina", "fiarahamonina", "tanora", "fianakaviana", "vahoaka",
    ],
    "santé": [
        "hôpital", "centre de santé", "médecin", "maladie", "vaccin", "urgence", "épidémie",
        "pandémie", "santé publique", "covid", "paludisme", "choléra", "campagne de vaccination",
        "hopitaly", "dokoterà", "aretina", "fahasalamana", "valanaretina",
    ],
    "éducation": [
        "école", "université", "enseignement", "étudiant", "professeur", "examen",
        "réforme scolaire", "baccalauréat", "rentrée scolaire", "formation professionnelle",
        "sekoly", "oniversite", "fanabeazana", "mpianatra", "mpampianatra",
    ],
    "technologie": [
        "technologie", "innovation", "numérique", "internet", "intelligence artificielle",
        "cybersécurité", "start up", "transformation digitale", "réseau mobile",
        "télécommunication", "haitao", "rindranasa", "aterineto", "tambajotra",
    ],
    "sport": [
        "football", "rugby", "basket", "match", "championnat", "équipe", "tournoi", "ligue",
        "sélection nationale", "qualification", "stade", "baolina kitra", "lalao", "ekipa",
        "fifaninanana", "stadiona",
    ],
    "culture": [
        "festival", "concert", "exposition", "cinéma", "théâtre", "album", "artiste", "patrimoine",
        "tradition", "danse", "musique", "littérature", "mozika", "kolontsaina",
    ],
    "environnement": [
        "climat", "écologie", "déforestation", "pollution", "biodiversité", "catastrophe naturelle",
        "cyclone", "sécheresse", "changement climatique", "protection de l environnement",
        "tontolo iainana", "toetrandro", "fandotoana", "rivodoza", "hain tany",
    ],
    "international": [
        "onu", "union européenne", "relations internationales", "conflit international",
        "diplomatie", "ambassade", "coopération bilatérale", "sommet international",
        "sanctions internationales", "iraisam pirenena", "ady iraisam pirenena",
    ],
    "transport": [
        "route", "aéroport", "transport public", "trafic", "infrastructure", "travaux publics",
        "accident de la route", "port maritime", "compagnie aérienne", "fitaterana",
        "seranam piaramanidina", "taxibe",
    ],
}

# --- fixed values: one descriptive line per category ------------------------

CATEGORY_DESCRIPTIONS = {
    "politique": "actualité politique gouvernement état élections",
    "justice": "tribunal police justice prison enquête",
    "économie": "finance économie entreprise marché croissance",
    "société": "social population sécurité emploi",
    "santé": "hôpital maladie santé vaccin",
    "éducation": "école université enseignement étudiant",
    "technologie": "technologie numérique innovation internet",
    "sport": "football sport championnat match équipe",
    "culture": "festival concert cinéma théâtre",
    "environnement": "climat écologie pollution biodiversité",
    "international": "relations internationales diplomatie conflit",
    "transport": "transport infrastructure route aéroport",
}

# --- fixed values: domain or source name -> display name --------------------

ORIGIN_NAMES = {
    "2424.mg": "2424 MG",
    "lgdi-madagascar.com": "LGDI Madagascar",
    "midi-madagasikara.mg": "Midi Madagasikara",
    "namana-studio.fr": "Namana Studio",
    "newsmada.com": "News Mada",
    "rsf.org": "RSF",
    "courrierinternational.com": "Courrier International",
    "lemonde.fr": "Le Monde",
    "lexpress.mg": "L’Express",
    "madagascar-tribune.com": "Madagascar Tribune",
    "youtube.com": "YouTube",
    "Malagasy News": "Malagasy News",
    "Orange Actu": "Orange Actu",
}

# --- fixed values: feed addresses, and names that tell a source's type ------

FEED_ADDRESSES = """
https://www.madagascar-tribune.com/spip.php?page=backend
https://www.lexpress.mg/feeds/posts/default
https://newsmada.com/feed/
https://midi-madagasikara.mg/feed/
https://2424.mg/feed/
https://rsf.org/fr/rss/afrique/madagascar/feed.xml
https://www.madagate.org/index.php?format=feed&type=rss
https://lgdi-madagascar.com/feed/
https://midi-madagasikara.mg/category/politique/feed/
https://midi-madagasikara.mg/category/economie/feed/
https://www.lexpress.mg/feeds/posts/default/-/Politique
https://www.lexpress.mg/feeds/posts/default/-/%C3%89conomie
https://newsmada.com/category/les-nouvelles/feed/
https://newsmada.com/category/les-nouvelles/politique/feed/
https://2424.mg/category/actualite/politique/feed/
https://2424.mg/category/actualite/economie/feed/
https://www.lemonde.fr/madagascar/rss_full.xml
https://www.courrierinternational.com/feed/rubrique/madagascar/rss.xml
https://news.google.com/rss/search?q=Madagascar&hl=fr&gl=FR&ceid=FR:fr
https://tanikomadagascar.com/feed/
https://namana-studio.fr/feed/
https://www.youtube.com/feeds/videos.xml?channel_id=UCK84qSI2bEMWkX9vUptkAlA
""".split()

# (mode, pattern, source type); the first rule that fits wins.
SOURCE_TYPE_RULES = [
    *[("prefix", address, "rss") for address in FEED_ADDRESSES],
    ("prefix", "Malagasy News", "scrap_html"),
    ("contains", "Orange Actu", "scrap_selenium"),
]
DEFAULT_SOURCE_TYPE = "inconnu"

# The one feed host whose documents carry text in front of the XML prologue.
JUNK_PREFIX_HOST = "midi-madagasikara"

# --- fixed values: constants written by the producers -----------------------

BLOCK_SOURCE = ("Orange Actu", "scrap_selenium", "https://actu.orange.mg/depeches/")
MESSAGE_SOURCE = ("Orange Actu WhatsApp", "whatsapp_channel_selenium")
FEED_SOURCE_TYPE = "RSS"
PAGE_SOURCE_TYPE = "scrap_html"

# site name, list address, link selector, content selector, date selector
SITES = [
    (
        "Malagasy News",
        "https://www.malagasynews.com/actualites/",
        "h2.post-title a",
        "div.entry-content",
        "span.date",
    ),
]

# --- fixed values: masking ---------------------------------------------------

BLANK_MASK = "VIDE"
MISSING_SENTIMENT = "Neutre"
MISSING_CATEGORY = "Autre"
