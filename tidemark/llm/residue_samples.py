"""Labelled sample that the residue models are fitted on, drawn from grammars of the classes.

The grammars say how such texts are made in general (who fails, how, what to do about it), in English, Spanish,
Portuguese, French, Italian and German; {a|b} stands for a choice. MOST_SAMPLES bounds the texts drawn for a class.
Words of keyboards, paths and identifiers are made by rules. Natural prose isn't listed here: its model is counted
over the whole corpus.
"""

from __future__ import annotations

import random
import re

#: Texts drawn for a class at most.
MOST_SAMPLES = 6_000

# --- filler ---

#: Words of the usual dummy Latin. Fixed values.
DUMMY_LATIN = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo "
    "consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum "
    "accumsan aenean aliquam ante arcu auctor augue bibendum blandit condimentum congue convallis cras curabitur dapibus diam dictum dignissim donec egestas elementum erat eros euismod facilisis fames felis fermentum "
    "feugiat fringilla fusce gravida hendrerit iaculis imperdiet integer interdum justo lacinia lacus laoreet lectus leo libero ligula lobortis luctus maecenas malesuada massa mattis mauris metus molestie mollis morbi "
    "nam nec neque nibh nostra nullam nunc odio orci ornare pede pellentesque pharetra phasellus placerat porta porttitor posuere praesent pretium proin pulvinar purus quam quisque rhoncus risus rutrum sagittis sapien "
    "scelerisque sem semper senectus sodales suscipit suspendisse tellus tincidunt tortor tristique turpis ultrices urna varius vehicula vel venenatis vestibulum vestra vitae vivamus viverra volutpat vulputate"
).split()
#: Rows of a keyboard and words that stand for nothing. Fixed values.
KEYS, NOTHING = ("qwertyuiop", "asdfghjkl", "zxcvbnm"), "foo bar baz qux blah bla test testing asdf qwer qwerty xyz abc yada dummy".split()

_COPY = "{text|copy|body copy|content|description|product description|title|headline|caption|paragraph|blurb|summary|story|bio|details|information}"
_TEXTO = "{texto|contenido|descripción|título|párrafo|resumen|titular}"
_TEXTO_PT = "{texto|conteúdo|descrição|título|parágrafo|resumo}"
_TEXTE = "{texte|contenu|description|titre|paragraphe|résumé}"
_TESTO = "{testo|contenuto|descrizione|titolo|paragrafo|riassunto}"
FILLER = [
    f"{{Your|Our|Product|Main|Some}} {_COPY} {{here|goes here|will go here|to go here}}.", f"{{Insert|Add|Enter|Put|Write|Type|Place|Paste}} {{your|product|the|some|a short|}} {_COPY} {{here|below|later|}}.",
    f"{_COPY} {{to follow|to come|coming soon|pending|goes here|to be supplied by the agency|to be supplied|to be added|to be confirmed|to be written|tbd|tbc|here}}.", f"{{This is|Here is}} {{dummy|sample|placeholder|filler|example|test|demo}} {_COPY}.",
    f"{{Dummy|Sample|Placeholder|Filler|Example|Demo}} {_COPY}, {{replace|change|remove|delete}} {{before|prior to}} {{publishing|printing|launch|going live|release}}.", f"{{Placeholder|Filler|Dummy|Sample}} {_COPY} {{for layout|for the layout|only|for design|for preview|for position only}}.",
    f"{{Short|Long|Full}} {_COPY} ({{to be written|to come|to follow|pending}})", "{TBD|TBA|TBC|TODO|FPO|FIXME}", "{TBD|TBA|TODO} {TBD|TBA|TODO} {TBD|TBA|TODO}", "{N.N.|Title here|Heading 0|Caption goes here|Replace me|Replace this text|Edit this text|Change me}",
    f"{{Su|Tu|El|Nuestro}} {_TEXTO} {{aquí|va aquí|irá aquí}}.", f"{{Aquí va|Aquí irá|Inserte aquí|Escriba aquí|Añada aquí}} {{el|su|la}} {_TEXTO}.", f"{_TEXTO} {{pendiente|por escribir|por redactar|de relleno|de ejemplo|de prueba|de muestra|en preparación|próximamente}}.",
    f"{_TEXTO} {{de ejemplo|de prueba|de relleno|provisional}}, {{sustituir|cambiar|reemplazar|borrar}} antes de {{publicar|imprimir}}.",
    f"{{O seu|O|A sua|A}} {_TEXTO_PT} {{aqui|vai aqui|fica aqui}}.", f"{{Insira|Escreva|Coloque}} aqui {{o|a}} {_TEXTO_PT}.", f"{_TEXTO_PT} {{pendente|em breve|por escrever|de enchimento|de exemplo|de teste|provisório}}.", f"{_TEXTO_PT} de exemplo, {{substituir|trocar|apagar}} antes de {{publicar|imprimir}}.",
    f"{{Votre|Le|La|Notre}} {_TEXTE} ici.", f"{{Insérez|Écrivez|Ajoutez|Saisissez}} {{votre|le|la}} {_TEXTE} ici.", f"{_TEXTE} {{à venir|à suivre|à écrire|à rédiger|de remplissage|d'exemple|de test|factice|provisoire}}.", f"{_TEXTE} {{factice|d'exemple|de remplissage}} à {{remplacer|changer|supprimer}} avant {{publication|impression}}.",
    f"{{Il tuo|Il|La tua|La}} {_TESTO} {{qui|va qui|andrà qui}}.", f"{{Inserire|Inserisci|Scrivere|Scrivi|Aggiungi}} qui {{il|la|il tuo|il vostro}} {_TESTO}.", f"{_TESTO} {{segnaposto|riempitivo|di esempio|di prova|da scrivere|in arrivo|provvisorio|da inserire}}.", f"{_TESTO} di {{esempio|prova}} da {{sostituire|cambiare}} {{prima della pubblicazione|prima della stampa|}}.",
    "{Ihr|Der} {Text|Titel|Inhalt} {hier|steht hier|folgt}.", "Hier {Text|Beschreibung|Titel} {einfügen|eingeben|ergänzen}.", "{Blindtext|Platzhaltertext|Beispieltext|Mustertext}{, vor Veröffentlichung ersetzen|}.", "{Beschreibung|Text|Inhalt} {folgt|folgt in Kürze|in Arbeit}.",
]

# --- error pages, error messages, notices about scripts ---

#: Status codes and their phrases. Fixed values.
_CODE = "{400|401|403|404|405|408|409|410|413|418|422|423|429|451|500|501|502|503|504|507|520|521|524}"
_STATUS = (
    "{Bad Request|Unauthorized|Forbidden|Not Found|Method Not Allowed|Not Acceptable|Request Timeout|Conflict|Gone|Payload Too Large|Unprocessable Entity|Locked|Too Many Requests|Unavailable For Legal Reasons|Internal Server Error|Not Implemented|"
    "Bad Gateway|Service Unavailable|Gateway Timeout|Insufficient Storage|Connection Timed Out|Web Server Is Down}"
)
_SITE = (
    "{page|web page|site|website|web site|server|web server|service|login service|system|application|app|document|file|form|order form|report|report viewer|viewer|catalogue|list|view|image|image server|content|resource|link|address|item|product|post|article|feature|section|video|database|"
    "basket|cart|checkout|search|account page|customer area|portal|dashboard|ledger|close|slip|return slip|upload|download|endpoint|host|upstream|backend|gateway}"
)
_WHO = f"{{The|This|Our|The requested|The selected|Your}} {_SITE}"
_FAILS = (
    "{could not be found|was not found|cannot be found|can't be found|does not exist|doesn't exist|no longer exists|no longer exists at this address|is not available|is not available right now|is unavailable|is temporarily unavailable|is currently unavailable|"
    "is under maintenance|is down for maintenance|is offline|could not be loaded|failed to load|failed to open|cannot be displayed|cannot be shown|could not be shown|cannot be shown to guests|has been moved|has moved|has moved or was deleted|was removed|was moved or deleted|"
    "has been deleted|has expired|expired|timed out|took too long to respond|took too long to answer|is not responding|did not respond|did not answer|gave no answer|returned no data|encountered an error|encountered an internal error|has crashed|crashed while rendering|crashed|"
    "stopped working|refused to connect|refused the connection|was reset|is overloaded|is too busy|requires you to sign in|is restricted|is private|is forbidden|could not be processed|could not be completed|was stopped|was cancelled|was denied|is invalid|was rejected by the server}"
)
_PLACE = "{this page|this site|this report|this order|this document|this resource|this area|this content|the requested page|this server}"
_TRY = (
    "{Please try again|Please try again later|Try again later|Please try again in a few minutes|Try reloading the page|Please reload the page|Reload the page|Check the address and try again|Check the address and reload|Check the URL|Please check your connection|"
    "Go back|Go back to the start page|Return to the home page|Back to home|Back to the start page|Contact support|Contact support if this keeps happening|Contact your administrator|Please contact the administrator|We have been notified|Our team has been notified|"
    "We are working on it|You will be redirected|You will be sent back to the start page|Sorry for the inconvenience|We apologise for the inconvenience|Sorry about that|Please sign in again|Please log in to continue|Sign in first|Thank you for your patience}"
)
_OOPS = (
    "{Something went wrong|Something broke on our side|Something is wrong|An error occurred|An error has occurred|An unexpected error occurred|An unexpected error has occurred|An internal error occurred|An unknown error occurred|A problem occurred|Unexpected error|Unknown error|"
    "Internal error|Server error|Network error|Connection error|Fatal error|Page not found|File not found|Document not found|Resource not found|Access denied|Permission denied|Not authorised|Session expired|Session timed out|Request timed out|Connection refused|Connection timed out|"
    "Invalid request|Bad request|Rate limit exceeded|Too many requests|Slow down|Under maintenance|Down for maintenance|Site under construction|Service unavailable|Temporarily unavailable|Content unavailable|Nothing to see here|We can't find that page|We couldn't find that page|Sorry, we can't find that page}"
)
_ID = "{0|A0|0B0|A0BC|0F0E|BD0CA|E0DC0|0C0B0F|DDDB0|FE0D0E0|F0EC0D|abc0-0def|0f0e0-d0}"
_LANG = "{ValueError|KeyError|TypeError|RuntimeError|IndexError|AttributeError|TimeoutError|ConnectionError|IOError|OSError|NullPointerException|IllegalStateException|OperationalError|ReferenceError|SyntaxError|SQLException|IOException|OutOfMemoryError|ServletException|PDOException|AssertionError}"
_WHY = "{bad value|bad month|bad input|null|'id'|'key'|'sku'|'name'|timed out|timeout|0 s|refused|connection refused|too many connections|no such file or directory|cannot read properties of undefined|division by zero|index out of range|invalid literal|not a valid date|undefined is not a function|out of memory|deadlock detected}"
_SAID = "{timed out|down for maintenance|server error|page not found|not found|this page was removed|access denied|slow down|sign in first|bad request|upstream did not answer|upstream timed out|internal error|unavailable|forbidden|try again later}"
_JS = "{JavaScript|Javascript|JS|scripts|scripting|client-side scripting|script support|browser scripts|scripts in the browser|cookies and JavaScript}"
_ON = "{enable|activate|allow|turn on|switch on|unblock}"
_AIM = "{to continue|to proceed|to view this page|to see this page|to use this site|to view this order|to see the content|to run this app|to display the report|and reload|and reload the page|and try again|in your browser|in your browser settings|for this site}"
NOTICE = [
    *[f"{_WHO} {_FAILS}."] * 10, f"{_OOPS}.", f"{_OOPS}!", f"{{Oops|Sorry|Whoops|Error|Oh no}}{{!|,|:}} {_OOPS}.", f"{_OOPS} while {{loading|opening|processing|saving|fetching|rendering}} {{the|your|this}} {_SITE}.", *[f"{_TRY}."] * 3, f"{_OOPS}. {_TRY}.",
    f"{{You do not have|You don't have}} {{permission|access|the rights}} to {{view|open|access|see|edit}} {_PLACE}.", f"You are not {{allowed|authorised|authorized|permitted}} to {{view|open|access|see}} {_PLACE}.", f"{{Access|Entry}} to {_PLACE} {{is|has been}} {{denied|forbidden|restricted|blocked}}.",
    f"{{We|Sorry, we}} {{could not|couldn't|can't|cannot|were unable to}} {{find|open|load|show|display|reach|process}} {{the|that|this|your}} {_SITE}{{| you asked for| you requested| you are looking for}}.",
    "{Your|The} {session|login|link|token|request|password} {has expired|expired|is invalid|timed out|took too long|took too long and was stopped|was blocked|could not be verified}{|, please sign in again|, please log in again}.",
    f"{_CODE} {_STATUS}", f"{_CODE} {_STATUS}.", f"{_CODE} - {_STATUS}", f"{_CODE} | {_STATUS}", *[f"{_STATUS}", f"{_STATUS}."] * 3, f"HTTP {_CODE}", f"HTTP Error {_CODE}", f"HTTP Status {_CODE} - {_STATUS}", f"HTTP {_CODE} - {_STATUS}", f"HTTP/1.1 {_CODE} {_STATUS}", f"Error {_CODE}", f"Error {_CODE}: {_SAID}", f"Error {_CODE} {_SAID}", f"ERROR: {_SAID}",
    f"Code {_CODE}.", f"Error code: {_CODE}", f"Status: {_CODE}", f"{_CODE} {_STATUS} - {_WHO} {_FAILS}.", f"HTTP {_CODE} - {_WHO} {_FAILS}.", f"<h1>{_CODE} {_STATUS}</h1>", f"<h1>{_CODE} {_STATUS}</h1><hr>{{nginx|app|server|apache|gateway}}/0.0", f"<title>{_CODE} {_STATUS}</title>",
    f'\x02"status": {_CODE}, "error": "{_STATUS}", "{{trace|id|path|timestamp}}": "{_ID}"\x03', f'\x02"message":"{_SAID}","code":{_CODE}\x03', f'\x02"error": \x02"code": {_CODE}, "message": "{_SAID}"\x03\x03', f'\x02"{{ok|success}}": false, "{{error|reason|message}}": "{_SAID}"\x03', f"<error><code>{_CODE}</code><message>{_SAID}</message></error>",
    f"{{Request id|Request ID|Reference|Incident|Trace id|Error id|Ray ID|Correlation id}}: {_ID}{_ID}", f"(ref {_ID}{_ID})", f"({{error|ref|code}} {_ID})",
    "Traceback (most recent call last):", 'File "%p.py", line 0, in %i', *["at %i.%i.%i(%i.java:0)", "at %i.%i(%i.java:0)", "at com.%i.%i.%i(%i.java:0)"] * 4, "at %i (%p.js:0:0)", "at async %i (%p.ts:0:0)", f'Exception in thread "{{main|worker-0|pool-0}}" {_LANG}: {_WHY}', *[f"{_LANG}: {_WHY}"] * 2, f"{_LANG}", f'Exception in thread "{{main|worker-0|pool-0}}" {_LANG}', f"Fatal error: {_LANG}: {_WHY} in /%p.php on line 0", f"Uncaught {_LANG}: {_WHY}", f"Caused by: java.lang.{_LANG}: {_WHY}", f"Warning: %i(): {_WHY} in /%p.php on line 0", "Segmentation fault (core dumped)", "... 0 more",
    f"{{Please|You need to|You must|To continue, please|Kindly}} {_ON} {_JS} {_AIM}.", f"{_JS} {{is|seems to be|appears to be|has been}} {{disabled|switched off|turned off|blocked|off|not enabled|not available|inactive}} in your browser.", f"It {{looks like|seems|appears that}} {_JS} {{is|are}} {{disabled|blocked|switched off|turned off}}.",
    f"{{This|Our|The}} {_SITE} {{needs|requires|only works with|relies on|does not work without|doesn't work without|works only with|cannot run without}} {_JS}{{| to work| to run| enabled| allowed| switched on}}.", f"{_JS} {{must be|needs to be|has to be}} {{enabled|turned on|switched on|allowed|active}} {_AIM}.", f"Without {_JS} {{nothing can be shown here|this page cannot be displayed|the content stays hidden|the {_SITE} cannot be shown}}.",
    f"To {{see|view|use|open}} {{the|this}} {_SITE}, {_ON} {_JS}{{| and reload| in your browser| first}}.", f"Sorry, {{the|this|our}} {_SITE} {{doesn't|does not|cannot}} work without {_JS}.", f"{{Our shop|This site|This page}} requires a browser with {_JS}.", f"{{Scripts|JavaScript}} {{are|is}} blocked, so the {_SITE} cannot be {{drawn|shown|loaded}}.", "Loading... If nothing appears, your browser is blocking scripts.", "If nothing {appears|happens}, {check that|make sure} scripts are {allowed|enabled}.",
    "{Your browser|This browser} {is not supported|is out of date|does not support JavaScript|is blocking scripts|blocks scripts}.", "{Cookies are needed as well|Cookies must be allowed too|Please also accept cookies|Reload once it is active|Then reload the page|Reload afterwards|See your browser's help for how to do it|See your browser's settings}.", f"<noscript>{{Please|You need to}} {_ON} {_JS} {_AIM}.</noscript>", f"noscript: the {_SITE} only works with scripts allowed.",
]
_SITIO = "{La página|Esta página|El sitio|Este sitio|El servidor|El servicio|El servicio de acceso|El sistema|El documento|Este documento|El archivo|El formulario|Este formulario|El informe|Este informe|El recurso|Este recurso|El enlace|La cesta|El pedido|La cuenta|La dirección|La imagen|La solicitud|La base de datos|La página solicitada|El catálogo|El contenido|Este contenido}"
_FALLA = "{no se encuentra|no se encontró|no existe|ya no existe|ya no existe en esta dirección|no está disponible|no está disponible en este momento|no está disponible temporalmente|está en mantenimiento|no se pudo cargar|no se puede mostrar|no se puede abrir|no respondió|no responde|tardó demasiado|tardó demasiado en responder|ha caducado|ha sido eliminado|fue retirado|se ha movido|ha cambiado de dirección|está fuera de servicio|ha fallado|requiere iniciar sesión}"
_GUION = "{JavaScript|JS|los scripts|la ejecución de scripts|el uso de scripts|scripts}"
_SITIO_PT = "{A página|Esta página|O site|Este site|O servidor|O serviço|O serviço de entrada|O sistema|O documento|O ficheiro|O arquivo|O formulário|Este formulário|O relatório|Este relatório|O recurso|Este recurso|A ligação|O cesto|A encomenda|A conta|O endereço|A imagem|O pedido|A página pedida|O catálogo|O conteúdo}"
_FALHA = "{não foi encontrada|não foi encontrado|não existe|já não existe|já não existe neste endereço|não está disponível|não está disponível neste momento|está em manutenção|não pôde ser carregado|não pode ser mostrada|não respondeu|não responde|demorou demasiado|demorou demasiado a responder|expirou|foi removido|foi movida|está fora de serviço|falhou|exige início de sessão}"
_SITE_FR = "{La page|Cette page|Le site|Ce site|Le serveur|Le service|Le service de connexion|Le système|Le document|Ce document|Le fichier|Le formulaire|Ce formulaire|Le rapport|Ce rapport|La ressource|Cette ressource|Le lien|Le panier|La commande|Le compte|L'adresse|L'image|La requête|La page demandée|Le catalogue|Le contenu}"
_ECHOUE = "{est introuvable|n'a pas été trouvée|n'a pas été trouvé|n'existe pas|n'existe plus|n'existe plus à cette adresse|n'est pas disponible|n'est pas disponible pour le moment|est indisponible|est temporairement indisponible|est en maintenance|n'a pas pu être chargé|ne peut pas être affichée|n'a pas répondu|ne répond pas|a mis trop de temps|a mis trop de temps à répondre|a expiré|a été supprimée|a été déplacé|est hors service|a échoué|exige une connexion}"
_SITO = "{La pagina|Questa pagina|Il sito|Questo sito|Il server|Il servizio|Il servizio di accesso|Il sistema|Il documento|Il file|Il modulo|Questo modulo|Il rapporto|Questo rapporto|La risorsa|Questa risorsa|Il collegamento|Il carrello|L'ordine|L'account|L'indirizzo|L'immagine|La richiesta|La pagina richiesta|Il catalogo|Il contenuto}"
_FALLISCE = "{non è stata trovata|non è stato trovato|non esiste|non esiste più|non esiste più a questo indirizzo|non è disponibile|non è disponibile in questo momento|è in manutenzione|non può essere caricata|non può essere mostrata|non ha risposto|non risponde|ha impiegato troppo|ha impiegato troppo a rispondere|ha impiegato troppo tempo a rispondere|è scaduta|è stata rimossa|è stato spostato|è fuori servizio|non ha funzionato|richiede l'accesso}"
NOTICE_ELSEWHERE = [
    *[f"{_SITIO} {_FALLA}."] * 4, "{Se ha producido un error|Ocurrió un error|Ha ocurrido un error|Error inesperado|Ha ocurrido un error inesperado|Algo ha fallado|Error interno|Error interno del servidor|Página no encontrada|Acceso denegado|Permiso denegado|Servicio no disponible|Servicio no disponible por mantenimiento|Sesión caducada|Su sesión ha caducado|Demasiadas solicitudes|Tiempo de espera agotado|Solicitud incorrecta|No encontramos la página solicitada|No hemos encontrado la página}.",
    "{Inténtelo más tarde|Inténtelo de nuevo más tarde|Vuelva a intentarlo|Inicie sesión de nuevo|Vuelva a la página de inicio|Volver al inicio|Compruebe la dirección|Vuelva a cargar la página|Vuelva a cargar después|Disculpe las molestias|Póngase en contacto con soporte|Estamos trabajando en ello|También hacen falta cookies|Luego recargue}.", "No tiene {permiso|acceso|autorización} para {ver|abrir} {esta página|este informe|este contenido|este recurso}.",
    f"{{Es necesario|Hay que|Debe|Necesita|Por favor,}} {{habilitar|activar|permitir|active|habilite}} {_GUION} {{para continuar|para ver esta página|en su navegador|en el navegador para ver el pedido|y recargue}}.", f"{{Active|Habilite|Permita}} {_GUION} {{en su navegador|}} {{para ver esta página|para continuar|y recargue}}.", f"{_SITIO} {{necesita|requiere|no funciona sin|solo funciona con}} {_GUION}.", f"Parece que {_GUION} {{está desactivado|están bloqueados|está apagado}}.", f"Sin {_GUION} no se puede {{mostrar|ver|cargar}} {{el pedido|la página|el contenido|el informe}}.", "Su navegador {no es compatible|no admite scripts|bloquea los scripts}.",
    *[f"{_SITIO_PT} {_FALHA}."] * 4, "{Ocorreu um erro|Ocorreu um erro inesperado|Erro inesperado|Algo correu mal|Erro interno|Erro interno do servidor|Página não encontrada|Acesso negado|Permissão negada|Serviço indisponível|Serviço indisponível para manutenção|Sessão expirada|A sua sessão expirou|Demasiados pedidos|Tempo esgotado|Não encontrámos a página|Não encontrámos a página pedida}.",
    "{Tente mais tarde|Tente novamente mais tarde|Tente de novo|Inicie sessão de novo|Volte à página inicial|Voltar ao início|Verifique o endereço|Recarregue a página|Depois recarregue|Pedimos desculpa pelo incómodo|Contacte o suporte|Também são precisos cookies}.", "Não tem {permissão|acesso|autorização} para {ver|abrir} {esta página|este relatório|este conteúdo}.",
    "{Ative|Ligue|Permita|Habilite} {o JavaScript|o JS|os scripts|o uso de scripts} {no navegador|no seu navegador|} {para ver esta página|para continuar|e recarregue}.", "{O JavaScript|O JS|O uso de scripts} está {desligado|desativado|bloqueado}{| no seu navegador}.", f"{_SITIO_PT} {{precisa de|requer|não funciona sem|só funciona com}} {{JavaScript|JS|scripts}}.", "Sem {JavaScript|JS|scripts} não é possível {mostrar|ver|carregar} {a encomenda|a página|o conteúdo}.",
    *[f"{_SITE_FR} {_ECHOUE}."] * 4, "{Une erreur s'est produite|Une erreur est survenue|Une erreur inattendue est survenue|Erreur inattendue|Quelque chose s'est mal passé|Erreur interne|Erreur interne du serveur|Page introuvable|Page non trouvée|Accès refusé|Accès interdit|Service indisponible|Service indisponible pour maintenance|Session expirée|Votre session a expiré|Trop de requêtes|Délai dépassé|Nous n'avons pas trouvé cette page}.",
    "{Réessayez plus tard|Veuillez réessayer plus tard|Veuillez réessayer|Reconnectez-vous|Retour à l'accueil|Revenez à la page d'accueil|Vérifiez l'adresse|Rechargez la page|Puis rechargez|Veuillez nous excuser|Contactez le support|Les cookies sont aussi nécessaires}.", "Vous n'avez pas {le droit|l'autorisation|accès} {de voir|d'ouvrir|d'accéder à} {cette page|ce rapport|ce contenu}.",
    "{Activez|Autorisez|Veuillez activer|Merci d'activer} {JavaScript|JS|les scripts} {pour afficher cette page|pour continuer|dans votre navigateur|et rechargez}.", "{JavaScript|JS|L'exécution de scripts} est {désactivé|désactivée|bloqué} dans votre navigateur.", f"{_SITE_FR} {{a besoin de|nécessite|ne fonctionne pas sans|exige}} {{JavaScript|JS|scripts}}.", "Sans {JavaScript|JS|scripts}, {la commande|la page|le contenu} ne peut pas {s'afficher|être affichée|être chargé}.",
    *[f"{_SITO} {_FALLISCE}."] * 4, "{Si è verificato un errore|Si è verificato un errore imprevisto|Errore imprevisto|Qualcosa è andato storto|Errore interno|Errore interno del server|Pagina non trovata|Accesso negato|Accesso vietato|Servizio non disponibile|Servizio non disponibile per manutenzione|Sessione scaduta|La sessione è scaduta|Troppe richieste|Tempo scaduto|Non abbiamo trovato la pagina}.",
    "{Riprova più tardi|Riprovi più tardi|Si prega di riprovare|Acceda di nuovo|Effettua di nuovo l'accesso|Torna alla pagina iniziale|Torna alla home|Controlla l'indirizzo|Ricarica la pagina|Poi ricarica|Ci scusiamo per il disagio|Contatta l'assistenza|Servono anche i cookie}.", "Non hai {il permesso|accesso|l'autorizzazione} {di vedere|di aprire|a} {questa pagina|questo rapporto|questo contenuto}.",
    "{Attiva|Abilita|Attivare|Si prega di attivare} {JavaScript|JS|gli script} {per vedere questa pagina|per continuare|nel browser|e ricarica}.", "{JavaScript|JS|L'esecuzione di script} è {disattivato|disattivata|bloccato} nel {browser|tuo browser}.", f"{_SITO} {{richiede|ha bisogno di|non funziona senza}} {{JavaScript|JS|script}}.", "Senza {JavaScript|JS|script} {l'ordine|la pagina|il contenuto} non può essere {mostrato|mostrata|caricato}.",
    "{Seite|Datei|Dokument|Artikel} {nicht gefunden|existiert nicht|nicht verfügbar}.", "Die {Seite|Website|Datei|Anwendung} {wurde nicht gefunden|existiert nicht mehr|ist nicht verfügbar|ist nicht erreichbar|konnte nicht geladen werden|wird gewartet|antwortet nicht}.", "{Zugriff verweigert|Interner Fehler|Interner Serverfehler|Ein Fehler ist aufgetreten|Sitzung abgelaufen|Zu viele Anfragen|Dienst nicht verfügbar|Zeitüberschreitung}.", "{Bitte versuchen Sie es später erneut|Zurück zur Startseite|Bitte melden Sie sich erneut an|Bitte laden Sie die Seite neu}.", "{Bitte aktivieren Sie|Aktivieren Sie} JavaScript{, um fortzufahren|, um diese Seite zu sehen| in Ihrem Browser}.", "JavaScript ist {deaktiviert|ausgeschaltet|in Ihrem Browser blockiert}.",
]
#: What stands around a notice: menus and footers. It counts neither for nor against.
_MENU = "{Home|Start|Orders|Returns|Help|Shop|Shops|Offers|New in|Sale|News|About|Contact|Search|Basket (0)|Account|Sign in|Register|Inicio|Pedidos|Ayuda|Contacto|Início|Encomendas|Ajuda|Accueil|Commandes|Aide|Panier|Ordini|Aiuto|Carrello|Kontakt|Hilfe}"
_BAR = "{ | | - | · | / | > }"
CHROME = [
    f"{_MENU} | {_MENU} | {_MENU}", f"{_MENU} | {_MENU} | {_MENU} | {_MENU}", f"{_MENU} - {_MENU} - {_MENU}", f"{_MENU} · {_MENU} · {_MENU}", f"{_MENU} · {_MENU} · {_MENU} · {_MENU}", f"{_MENU} / {_MENU}", f"{_MENU} > {_MENU}", f"You are here: {_MENU} > {_MENU}", "{Menu|Menú|Menù}  {Search|Buscar}  {Basket (0)|Cesta (0)}", "{Skip|Jump} to {content|main content|navigation}", "{Cookie settings|Cookies|Cookie policy|Manage cookies}", "© {2024|2025|2026} {All rights reserved|Alle Rechte vorbehalten|Todos los derechos reservados|}", "{Back|Return} to {start page|home|top}", "Contact us - Terms - Privacy", "{Terms|Terms and conditions|Privacy|Privacy policy|Imprint|Sitemap|Newsletter|Follow us|Log in|Log out|Sign in / Register}", "{Privacy|Terms|Imprint} | {Contact|Cookies|Sitemap}",
]

# --- natural texts that share the words of the classes ---

_STAFF = "{The customer|A customer|The supplier|The shop|A colleague|The depot|The auditor|The landlord|The vendor|Our agency|The courier|Staff|The team|The buyer|She|He|We|They|The intern|The developer|The tester|Marketing}"
_WHEN = "{yesterday|last week|on Monday|in May|in July|twice|once|again|this morning|for 0 minutes|for two days|before the close|after the update|during the sale|since March|until Friday}"
_THINGS = "{cellar|garden|roof|garage|warehouse|stock room|back door|gate|car park|kitchen|heating|lift|bathroom|loading bay|water pipe|gas line|till|shelf|second floor|attic|barn|workshop}"
MENTION = [
    f"{{Access|Entry|The way|The door|Connection}} to the {_THINGS} {{is|was|has been|stays}} {{denied|refused|forbidden|blocked|closed|restricted|not allowed|not possible}} {{to visitors|by the landlord|for customers|to guests|for the public|at night|by the owner|during works}}.", f"The {{key|lid|receipt|box|parcel|ticket|lamp|cable|screw|coat}} {{could not be found|was not found|is not available|was removed|has been moved|timed out|was refused|expired}} {{in|at|from|near|under}} the {_THINGS}.",
    f"{{The offer|The guarantee|The permit|The contract|The milk|The coupon|Her passport}} {{expired|has expired|is no longer valid}} {_WHEN}{{| and was renewed|, so we extended it}}.", f"{_STAFF} {{saw|reported|got|noticed|mentioned|wrote about|asked about|complained about}} {{error {_CODE}|an error page|a {_CODE} {_STATUS}|'{_STATUS}'|the message '{_SAID}'|a blank page|a timeout|an outage}} {_WHEN}{{| and then ordered by phone|, the order came through anyway|, it works again|, the new address is in the handbook}}.",
    f"{_WHEN} the {{server|site|till|printer|scanner|report server|old link}} {{answered|returned|showed|gave|logged}} {{error {_CODE}|{_CODE} {_STATUS}|{_STATUS}}} {_WHEN}{{|, then the close ran as usual|, nobody noticed|, then it sold as normal}}.", f"{{Please count|We counted|Check|Note}} how often the {{tills|servers|shops}} {{logged|saw|showed}} {_CODE} {_STATUS} {_WHEN}, the vendor claims never.",
    f"{{A|The}} {_LANG} in the {{loader|import|job|script}} cost us {{0 records|an hour|a night}}, {{all were read again|it is fixed|we repeated the run}} {_WHEN}.", f"{_STAFF} {{fixed|corrected|explained|found|closed}} the {{error|bug|problem|fault}} {{in the sheet|on the page|in the form|in the report}} {_WHEN}.", "{Error|Fault|Mistake} in the {sheet|list|file|price}, {corrected|fixed|solved}.", f"{_STAFF} could not open the {{report|file|form|door|lid}} {{on the first try|at first|yesterday}}, {{the second copy worked|the second try did}}.", "Not found in {stock|store|the shop|the depot}.", f"The {{number|street|house|address}} {{does not exist|was not found}} in {{this town|the register|our list}}, so the {{courier|driver|postman}} came back {_WHEN}.",
    f"The {{form|page|site|shop|returns page|plain version}} {{works|worked|sells|loads}} without {{JavaScript|scripts|JS}} since {{0|May}}, {{so older tablets can be used again|and nobody missed it}}.", "Turn JavaScript off when you test the plain version of the page, then compare the {totals|results}.", f"{_STAFF} asked {{whether|why|if}} {{JavaScript|scripting}} is {{needed|enabled|required|used}} {{on the tablets|for the form|in the shop}}{{|, the answer is no}}.", "We {teach|write|use|learn} JavaScript {in the evening class|for the web shop|at work}.",
    f"{{The supplier's|The agency's|Their|The first}} {{blurb|draft|copy|page|flyer}} was {{only|just|mostly}} {{lorem ipsum|filler text|dummy text|placeholder text}}{{;|, so|and}} {_STAFF} {{refused it|asked for a real one|sent it back|wrote a new one}}.", "The {filler|dummy|sample} text in the {spring|autumn|new} catalogue was replaced by real copy before print.", "The TODO list of the close is empty, TBD items moved to the next one.", f"{_STAFF} {{wrote|asked for|sent|approved|checked|translated}} the {{description|text|copy|title}} {_WHEN}.", "The {text|description} on the {box|label} is {here|wrong|in French}.",
    f"El {{servidor|formulario|almacén}} {{respondió|dio|mostró}} {{error {_CODE}|{_CODE} {_STATUS}}} durante 0 minutos y {{después|luego}} {{cerró sin problema|vendió con normalidad}}.", f"La caja registró {{error {_CODE}|{_CODE} {_STATUS}}} dos veces y luego vendió con normalidad.", "{Error|Fallo} en la {hoja|lista}, {corregido|resuelto}.", "No {encontrado|hallado} en {tienda|almacén|la estantería}.", "El {formulario|sitio} funciona sin JavaScript desde {mayo|0}.", "El texto del proveedor era relleno y lo rechazamos.", "El acceso {al sótano|a la azotea|al almacén} está {prohibido|cerrado|denegado} a los {clientes|visitantes}.", "La garantía ha caducado, {el cliente lo sabe|la renovamos}.",
    f"O servidor deu {{error {_CODE}|{_CODE} {_STATUS}}} durante 0 minutos e depois fechou {{maio|0}}.", "Erro na {folha|lista}, corrigido.", "Não encontrado {na loja|no armazém}.", "A página funciona sem JavaScript desde {maio|0}.", "O texto do fornecedor era de enchimento e foi recusado.", "O acesso {à cave|ao armazém|ao telhado} está {proibido|fechado|negado} aos {clientes|visitantes}.",
    f"Le serveur a répondu {{error {_CODE}|{_CODE} {_STATUS}}} pendant 0 minutes, puis tout est rentré dans l'ordre.", "Erreur dans la {feuille|liste}, corrigée.", "Pas trouvé {en magasin|au dépôt}.", "La page marche sans JavaScript depuis {mai|0}.", "Le texte du fournisseur était du remplissage, refusé.", "L'accès {à la cave|au toit|au dépôt} est {interdit|fermé|refusé} aux {clients|visiteurs}.", "La garantie a expiré, {le client le sait|on la prolonge}.",
    f"Il server ha dato {{error {_CODE}|{_CODE} {_STATUS}}} per 0 minuti, poi ha chiuso {{maggio|0}}.", "Errore nel {foglio|listino}, corretto.", "Non trovato in {negozio|magazzino}.", "La pagina funziona senza JavaScript da {maggio|0}.", "Il testo del fornitore era riempitivo, rifiutato.", "L'accesso {alla cantina|al tetto|al magazzino} è {vietato|chiuso|negato} ai {clienti|visitatori}.",
    "{Checked|Checked twice|Done|Closed|Fixed|Solved|Paid|No reply yet|Fine by me|See above|OK|Noted}.", "{Revisado|Hecho|Cerrado|Sin respuesta|Pagado}.", "{Revisto|Feito|Fechado|Sem resposta}.", "{Vérifié|Fait|Fermé|Pas de réponse|Payé}.", "{Fatto|Verificato|Chiuso|Nessuna risposta}.", "{Geprüft|Erledigt|Keine Antwort}.",
]

#: What people write of their days, so that sentences far from the corpus' subjects aren't taken for residue because the
#: corpus doesn't have their words: who does what, where and when.
_DAY = "{today|yesterday|on Tuesdays|every morning|last year|next week|at noon|in winter|after lunch|since then|in the evening|for years|at the weekend|on the way home|when it rained}"
_SPOT = "{in the garden|at the station|near the river|in our street|at school|in the office|in town|on the bus|at the market|by the window|in the mountains|at home|next door|in the hall|behind the church}"
_OBJECT = "{the letter|a new coat|our neighbour|the old car|two tickets|some bread|the way|a small flat|the doctor|the children|her brother|the results|a long walk|the dog|good advice|the paper|three chairs|the map|an answer|the name of the street}"
EVERYDAY = [
    f"{{I|We|They|She|He|My sister|His father|The teacher|Nobody|Everyone|The children|Our friends|A man|The old woman}} {{found|lost|bought|saw|heard about|wrote about|asked for|waited for|forgot|repaired|painted|sold|moved|closed|opened|checked|turned off|turned on|carried|needed|wanted|liked|read|sent|called|helped with|paid for|talked about|brought back}} {_OBJECT} {{{_SPOT}|{_DAY}|and went home|but it was too late|because it was cheap|and it worked}}.",
    f"{{I|We|They|You|She|He}} {{was not|were not|am not|could not|did not|will|would|must|need to|have to|should|may|can}} {{find|lose|buy|see|bring|allow|activate|enable|wait for|repeat|leave|move|open|contact|try|sign|answer|reach|load|show|fill in|remove}} {_OBJECT} {{{_DAY}|{_SPOT}|before the trip|when you leave|if it stops|and will call you tomorrow}}.",
    f"{{The|Our|This|Her|That}} {{road|bridge|house|film|train|museum|book|river|garden|weather|meeting|school|story|recipe|music|game|shop|door|lamp|window|novel|village|bus|team|paragraph|title|text|page|site|report|session|error|service}} {{was|is|has been|will be|looks|became}} {{long|old|closed for the summer|open until nine|very good|not far from here|too small|well known|full of people|hard to read|on the left|finally repaired|cancelled because of snow|better than expected|a matter of taste}}{{| {_DAY}| {_SPOT}}}.",
    f"{{Ring|Wait|Ask|Come back|Try again|Call|Turn left|Look out|Remember to eat|Bring a coat|Please sit down|Please contact me|Please help {_OBJECT}}} {{{_DAY}|{_SPOT}|, the shop opens at nine|, it is worth it|if you can|before it gets dark}}.", "It takes {two|four|some} {eggs|hours|days|spoons of sugar|pieces|metres}, {0 g of flour|a little salt|a good book} and {some|a lot of} {patience|time|luck}.",
    "{Mi hermana|El vecino|Mi padre|La profesora|Nadie|Todos|El perro|La gente} {encontró|perdió|compró|vio|escribió|cerró|abrió|arregló|olvidó|vendió|esperó} {la carta|el coche|una mesa|dos entradas|el camino|la llave|un libro|el pan} {ayer|en la calle|en el pueblo|por la mañana|el domingo|antes de comer}.", "{La carretera|El puente|El museo|La casa|La puerta|La lluvia|El libro|La hoja doce} {está|fue|era|parece} {cerrada los lunes|muy larga|abierto hasta las nueve|rota|demasiado pequeño|lejos de aquí|muy amable|mejor que antes}.", "No {encontramos|vimos|hay|teníamos} {sitio|mesa|tiempo|pan|a nadie} en {el teatro|la plaza|casa|el restaurante}.",
    "{A minha irmã|O vizinho|O professor|Ninguém|Todos|O cão} {encontrou|perdeu|comprou|viu|escreveu|fechou|abriu|esqueceu|vendeu|esperou} {a carta|o carro|uma mesa|o caminho|a chave|um livro|o pão} {ontem|na rua|na aldeia|de manhã|ao domingo|antes do almoço}.", "{A estrada|A ponte|O museu|A casa|A porta|O livro} {está|foi|era|parece} {fechada à segunda|muito longa|aberto até às nove|pequeno demais|longe daqui|melhor do que antes}.", "Não {encontrámos|vimos|há|tínhamos} {lugar|mesa|tempo|pão|ninguém} {para ficar|no teatro|na praça|em casa}.",
    "{Ma sœur|Le voisin|Mon père|La maîtresse|Personne|Tout le monde|Le chien} {a trouvé|a perdu|a acheté|a vu|a écrit|a fermé|a ouvert|a oublié|a vendu|a attendu} {la lettre|la voiture|une table|le chemin|la clé|un livre|le pain} {hier|dans la rue|au village|le matin|dimanche|avant midi}.", "{La route|Le pont|Le musée|La maison|La porte|Le livre} {est|a été|était|semble} {fermé le lundi|très longue|ouvert jusqu'à neuf heures|trop petit|loin d'ici|réparée après l'orage|mieux qu'avant}.", "Nous n'avons pas {trouvé|vu|eu} de {place|table|temps|pain} {au théâtre|sur la place|à la maison|en ville}.",
    "{Mia sorella|Il vicino|Mio padre|La maestra|Nessuno|Tutti|Il cane} {ha trovato|ha perso|ha comprato|ha visto|ha scritto|ha chiuso|ha aperto|ha dimenticato|ha venduto|ha aspettato} {la lettera|la macchina|un tavolo|la strada|la chiave|un libro|il pane} {ieri|per strada|in paese|la mattina|domenica|prima di pranzo}.", "{La strada|Il ponte|Il museo|La casa|La porta|Il libro} {è|è stata|era|sembra} {chiuso il lunedì|molto lunga|aperto fino alle nove|troppo piccolo|lontano da qui|meglio di prima}.", "Non abbiamo {trovato|visto|avuto} {posto|un tavolo|tempo|il pane|nessuno} {a teatro|in piazza|a casa|, ma è tornato}.",
    "{Meine Schwester|Der Nachbar|Mein Vater|Die Lehrerin|Niemand|Der Hund|Wir|Ich} {hat|haben|habe} {den Brief|das Auto|einen Tisch|den Weg|das Buch|das Brot|die Tasche} {gestern|auf der Straße|im Dorf|am Morgen|am Sonntag|vor dem Essen} {gefunden|nicht gefunden|verloren|gekauft|gesehen|geschrieben|vergessen|verkauft}.", "{Die Straße|Das Museum|Das Haus|Die Tür|Der Garten|Das Wetter} {ist|war|bleibt} {am Montag geschlossen|sehr lang|bis neun Uhr offen|zu klein|weit weg|besser als früher|bis Juni gesperrt}.",
]

# --- what stands around a placeholder (@) ---

#: Texts sent without filling it in: greetings and small words that stand around anything, so that they say nothing about it.
_HI = "{Dear|Hello|Hi|Good morning|Hola|Estimado|Estimada|Olá|Caro|Cara|Bonjour|Cher|Chère|Ciao|Gentile|Buongiorno|Hallo|Liebe}"
AROUND = [
    f"{_HI} @, ", f"{_HI} @, your @ {{is|has|was}} ", "{Regards|Best wishes|Thanks|Sincerely|Saludos|Cumprimentos|Cordialement|Saluti|Grüße}, @", "{in|for|with|from|of|to|at|by|and|on|about|the|your|our|this} @ {is|was|has|will be|in|on|at|for|from|and|with|to|by|of|or} {the|a|your|our|this|sent|ready|it}",
    "{we|you|they|I} {found|sent|got|have|took|saw|moved|set|put|need|wrote} @ {in|on|at|to|for|from} the", "{the|your|our|this|a} {template|draft|manual|code|script|query|editor|source|list|group|item|text|column|cell|field|field name|tag|total|month} {of|for|from|in|to|with} @ {is|was|and|has}", "{the|your|our|a} @ {list|group|item|order|is|was|of|in}",
    "@ is {ready|booked|on its way|paid|late|cancelled|here|with us}", "{your|the} {order|booking|visit|table|room|parcel|call} with @", "{vous|votre|vos} {commande|colis|visite|table|réservation} est {prête|payée|arrivé|en route}", "bonjour @, votre {commande|visite|table|réservation|colis} est", "hola @, su {pedido|visita|mesa|reserva} está {lista|pagado|en camino}", "olá @, a sua {encomenda|visita|mesa|reserva} está {pronta|paga|a caminho}", "ciao @, {il tuo ordine|la tua visita|il tavolo} è {pronto|pagato|in arrivo}", "hallo @, {ihre bestellung|ihr tisch|ihr paket} ist {fertig|bezahlt|unterwegs}", "{holds|shows|has|reads|uses|contains} the", "and found {the|it}", "nothing is", "of the {shop|order|sheet|customer|month|box}", "on {monday|friday|the}", "{is|are} set by the", "must not be", "{searched|looked} for the", "{the|your} {string|word|parameter|marker|token}", "{for|to|in} the {template|draft|manual|script}",
    "{order|refund|account|invoice|parcel|close|month|reason|date|name|address|ship to|ref}: @", "{your|the} {order|refund|parcel|invoice|account} @ {has|was|is|of @} {shipped|approved|received|signed by @|ready|closed}", "thank you for {buying|your order|choosing} @ at @", "we could not reach you about {order|parcel} @",
    "{de|del|en|para|por|con|el|la|su|a} @ {de|del|en|el|la|y|es|se|con|para|por|al}", "{de|da|do|em|para|por|com|o|a} @ {de|da|do|em|e|o|a|foi|é|no|na|nos|nas|com|para|por}", "{de|du|à|pour|par|avec|le|la|votre} @ {de|du|à|est|le|la|et|dans|pour|par|avec}", "{di|del|da|per|con|il|la|su|a} @ {di|del|è|il|la|e|nel|nella|per|con|viene|da}",
    "{el|la} {campo|marcador|variable|borrador|plantilla} {de|del}", "{o|a} {campo|marcador|variável|rascunho|modelo} {de|do|da}", "{le|la} {champ|marqueur|variable|brouillon|modèle} {de|du}", "{il|la} {campo|segnaposto|variabile|bozza|modello} {di|del}",
    "{su|el} pedido @ {sale|llega} el @", "gracias por {comprar|su pedido} @", "motivo {del ajuste|de la devolución}: @", "a encomenda @ {sai|chega} a @", "motivo do {ajuste|pedido}: @", "votre commande @ part le @", "motif {de la correction|du retour} : @", "il {tuo|suo} ordine @ parte il @", "motivo della {rettifica|richiesta}: @", "{cierre|fecho|clôture|chiusura} de @ {firmado|assinado|signée|firmata} {por|par|da} @",
]
#: What is said of a placeholder (@), or of a name in code or a table, in texts about it, whatever the rest of the sentence is.
_THING = "{placeholder|marker|variable|token|merge field|template variable|tag|parameter|macro|field|keyword}"
_SHEET = "{template|draft|manual|code|script|query|config file|settings file|editor|source|document|letter}"
ABOUT = [
    "{write|type|enter} @ {where|wherever|literally|as is}", "{to write|to type} @ in the", f"write @ in the {_SHEET}", f"{{a|the|this}} {_THING} @ ", f"{_THING}s {{like|such as}} @ ", "variables {like|such as} @ are", f"@ is {{a|the}} {_THING}", "@ stands for the", "that @ stands for", "@ is {replaced|substituted|filled in} {by|with|when}", "{replace|substitute} @ {by|with} the",
    "@ must not be {typed|translated|changed}", "@ still in it", "the literal @ ", "the {text|string|word} @ ", "{searched|grepped|looked|search|looking} for @ ", "we searched the", "{looked|searched} for @ in all", " for @ and found {none|nothing|no}", "why does the draft", f"the {_SHEET} {{uses|shows|contains|reads|has}} @ ", f"in the {_SHEET}, @ ", f"does the {_SHEET} for", " show @?", "{instead|in place} of @ ", "in place of the {braces|brackets|markers}", "with @ in place of",
    "in {python|java|sql|html|the code|the shell}, ", "f'@' ", "@ inserts the", "the {variable|value|field|parameter}'s value", "select @ from", " from @.", "`select ", "cell @ holds", "cells @ and @", "column @ holds", "holds the total and @ the", "engraving text is", "the payload was @", "the regex @", "the syntax @", "the @ {list|groups|items} ", "the query reads @ from",
    "se {sustituye|reemplaza|cambia} por {el|la}", "@ se {sustituye|reemplaza}", "en la plantilla, @ ", "la plantilla usa @ ", "{el marcador|la variable|el campo} @ ", "{buscamos|busqué|buscar} @ en", "el borrador de", "el borrador muestra @", " muestra @", "escribir @ donde", "escriba @ donde", "variables como @ ",
    "@ é {trocado|substituído} {pelo|pela|por}", "no modelo, @ ", "o modelo usa @ ", "{o marcador|a variável|o campo} @ ", "{procurámos|procurei|procurar} @ n", "o rascunho mostra @", "escreva @ onde", "variáveis como @ ",
    "@ est remplacé par", "dans le modèle, @ ", "le modèle utilise @ ", "{le marqueur|la variable|le champ} @ ", "{cherché|chercher|cherchons} @ dans", "le brouillon montre @", "écrivez @ à l'endroit", "des variables comme @ ",
    "@ viene sostituit{o|a} d", "nel modello, @ ", "il modello usa @ ", "{il segnaposto|la variabile|il campo} @ ", "{cercato|cercare|cerchiamo} @ {nel|nei|nella|nelle} ", "la bozza mostra @", "scriva @ dove", "variabili come @ ",
    "@ wird {durch|beim}", "{der platzhalter|die variable|das feld} @ ", "schreiben sie @ {wo|dort}",
]

#: Parts that paths and identifiers are made of.
_PARTS = "app src lib core main index view views utils service api web shop order user page report http db srv var www home usr model load open fetch render run get handle close read write batch item line data".split()


def _identifier(r: random.Random) -> str:
    a, b = r.choice(_PARTS), r.choice(_PARTS)
    return r.choice([a, a, f"{a}_{b}", f"{a}_{b}", a + b.capitalize(), a.capitalize() + b.capitalize(), a.capitalize()])


def _choices(template: str, r: random.Random) -> str:
    while True:
        out = re.sub(r"\{([^{}]*)\}", lambda m: r.choice(m[1].split("|")), template)
        if out == template:
            break
        template = out
    out = re.sub(r"(?<!\d)0(?!\d)", lambda m: "0" * r.choice([1, 1, 2, 3]), out)
    out = re.sub("%p", lambda m: "/".join(_identifier(r) for _ in range(r.randint(1, 3))), out)
    return re.sub("%i", lambda m: _identifier(r), out).replace("\x02", "{").replace("\x03", "}")


def expand(templates: list[str], n: int, seed: int) -> list[str]:
    """n texts, MOST_SAMPLES at most, evenly over the templates."""
    r = random.Random(seed)
    return [_choices(templates[i % len(templates)], r) for i in range(min(n, MOST_SAMPLES))]


def _mashed(r: random.Random) -> str:
    """Keys struck along a row of the keyboard, once or twice."""
    row = r.choice(KEYS)
    at = r.randrange(len(row) - 2)
    return row[at : at + r.randint(3, 5)] * r.choice([1, 1, 2])


def _crosses(r: random.Random) -> str:
    """A row of one letter."""
    return r.choice("xxxxxXXXXXzZ") * r.randint(2, 6)


def samples(seed: int = 1) -> dict[str, list[str]]:
    """By class the texts to fit on; the same for a seed, whatever the corpus."""
    r = random.Random(seed)
    latin = [" ".join(r.choice(DUMMY_LATIN) for _ in range(r.randint(4, 14))).capitalize() + "." for _ in range(2500)]
    struck = [" ".join(r.choice([r.choice(NOTHING), r.choice(NOTHING), _mashed(r)]) for _ in range(r.randint(3, 12))) for _ in range(400)]
    crosses = [" ".join(_crosses(r) for _ in range(r.randint(3, 12))) for _ in range(400)]
    return {
        "filler": latin + struck + crosses + expand(FILLER, 2200, seed),
        "notice": expand(NOTICE, 3500, seed) + expand(NOTICE_ELSEWHERE, 2500, seed + 1),
        "chrome": expand(CHROME, 600, seed),
        "mention": expand(MENTION, 3000, seed),
        "everyday": expand(EVERYDAY, 6000, seed),
        "unfilled": expand(AROUND, 2500, seed),
        "about": expand(ABOUT, 1500, seed),
    }
